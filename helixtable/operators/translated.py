"""Search of proteins in genomes: both strands are translated in all frames, and hits have their places on the genome.

A genome comes in pieces that overlap, so that one record may span many of them. Residues are read at every base of a piece at
once, which gives all frames; a k-mer of residues is a number of five bits a residue, and places whose number no query has go before
they become rows. Codons with other letters than the four bases give X, which no seed holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtable.operators.extension import PROTEIN, WIDTH, Scoring, extended, runs, with_letters
from helixtable.operators.lookup import SENT, Wanted, held
from helixtable.operators.seeds import AMINO, seed_join

RESIDUES = "".join(sorted(set(AMINO)))
MOST_K = 12
BASE = np.full(256, 4, dtype=np.int64)
BASE[np.frombuffer(b"TCAG", dtype=np.uint8)] = np.arange(4)
CODON = np.array([RESIDUES.index(a) for a in AMINO], dtype=np.int64)
PAIRED = np.array([2, 3, 0, 1, 4], dtype=np.int64)
#: Residues by number, the last one for unknown ones.
LETTERS = np.frombuffer((RESIDUES + "X").encode(), dtype=np.uint8)
COMPLEMENT = str.maketrans("ACGT", "TGCA")
LETTER = np.full(256, -1, dtype=np.int64)
LETTER[np.frombuffer(RESIDUES.encode(), dtype=np.uint8)] = np.arange(len(RESIDUES))


def overlap(k: int) -> int:
    """Letters that pieces of a genome must have beyond their width."""
    return 3 * k - 1


def _numbers(residues: np.ndarray, k: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the k-mers from each place on, and whether all their residues are known."""
    n = max(0, len(residues) - step * (k - 1))
    number, known = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for j in range(k):
        r = residues[j * step : j * step + n]
        number = number << 5 | np.maximum(r, 0)
        known &= r >= 0
    return number, known


def _residues(bases: np.ndarray) -> np.ndarray:
    """The residue that starts at each base, -1 for unknown ones."""
    if len(bases) < 3:
        return np.zeros(0, dtype=np.int64)
    a, b, c = bases[:-2], bases[1:-1], bases[2:]
    known = (a < 4) & (b < 4) & (c < 4)
    return np.where(known, CODON[np.where(known, 16 * a + 4 * b + c, 0)], -1)


def _places(dna: str, k: int) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Strand, places (from 0) of the first base read and numbers of all known k-mers."""
    bases = BASE[np.frombuffer(dna.encode("ascii", "replace"), dtype=np.uint8)]
    number, known = _numbers(_residues(bases), k, 3)
    at = np.flatnonzero(known)
    yield "+", at, number[at]
    number, known = _numbers(_residues(PAIRED[bases[::-1]]), k, 3)
    at = np.flatnonzero(known)
    yield "-", len(bases) - 1 - at, number[at]


def _proteins(b: pa.RecordBatch) -> list[str]:
    """Residues from the letter behind skip on, of each row's letters or their reverse complement."""
    rows = zip(*(b.column(c).to_pylist() for c in ("letters", "minus", "skip")))
    dna = [(t[::-1].translate(COMPLEMENT) if minus else t)[skip:] for t, minus, skip in rows]
    read = LETTERS[_residues(BASE[np.frombuffer("".join(dna).encode("ascii", "replace"), dtype=np.uint8)])]
    starts = np.cumsum([0, *map(len, dna)]).tolist()
    return [read[i : i + len(d) // 3 * 3 : 3].tobytes().decode() if len(d) > 2 else "" for i, d in zip(starts, dna)]


def protein_kmers(queries: DataFrame, k: int) -> DataFrame:
    """query, kmer (a number) and q_pos of queries(query, sequence)."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in held(batches, "sequence"):
            # a letter that no k-mer holds lies between sequences
            number, known = _numbers(LETTER[np.frombuffer("X".join(texts).encode("ascii", "replace"), dtype=np.uint8)], k, 1)
            at = np.flatnonzero(known)
            starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
            row = np.searchsorted(starts, at, side="right") - 1
            yield pa.RecordBatch.from_arrays([b.column("query").take(pa.array(row)), pa.array(number[at]), pa.array(at - starts[row] + 1)], names=["query", "kmer", "q_pos"])

    kind = queries.schema["query"].dataType.simpleString()
    return queries.select("query", "sequence").mapInArrow(part, f"query {kind}, kmer long, q_pos long")


def genome_kmers(pieces: DataFrame, k: int, width: int, asked: DataFrame | None = None) -> DataFrame:
    """subject, strand, kmer and s_pos (of the base that is read first) of pieces(subject, first, sequence) of width letters and overlap(k) more.

    asked(kmer): the numbers looked for; where they are SENT at most, others are left out by the tasks.
    """
    assert k <= MOST_K
    wanted = None
    if asked is not None and asked.count() <= SENT:
        wanted = pieces.sparkSession.sparkContext.broadcast(Wanted(asked.toArrow()["kmer"].to_numpy()))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in held(batches, "sequence"):
            starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
            first = b.column("first").to_numpy()
            for strand, at, number in _places("N".join(texts), k):
                if wanted is not None:
                    hit = wanted.value.places(number.astype(np.uint64))
                    at, number = at[hit], number[hit]
                row = np.searchsorted(starts, at, side="right") - 1
                place = at - starts[row]
                # a k-mer belongs to the piece that has its lowest base among the first width ones
                own = np.flatnonzero((place if strand == "+" else place - (3 * k - 1)) < width)
                row, place, number = row[own], place[own], number[own]
                yield pa.RecordBatch.from_arrays([b.column("subject").take(pa.array(row)), pa.array([strand] * len(row), pa.string()), pa.array(number), pa.array(place + first[row])], names=["subject", "strand", "kmer", "s_pos"])

    kind = pieces.schema["subject"].dataType.simpleString()
    return pieces.select("subject", F.col("first").cast("long"), "sequence").mapInArrow(part, f"subject {kind}, strand string, kmer long, s_pos long")


def translated_search(queries: DataFrame, pieces: DataFrame, k: int = 6, width: int = WIDTH, scoring: Scoring = PROTEIN, drop: int = 20, hot: int = 1000) -> DataFrame:
    """query, subject, strand, q_start, q_end (residues), s_start, s_end (bases, falling on the minus strand), aln_len, matches, mismatches, pct_identity, score, seed_count, subject_sequence.

    queries(query, sequence) of proteins, one row each; pieces(subject, first, sequence) of bases, in any case: first is 1 more than a multiple of
    width, and a piece has width letters and overlap(k) or more of the following ones, as far as there are any.
    """
    queries, pieces = queries.withColumn("sequence", F.upper("sequence")), pieces.withColumn("sequence", F.upper("sequence"))
    own = protein_kmers(queries, k)
    places = genome_kmers(pieces, k, width, own.select("kmer").distinct())
    seeds = seed_join(own, places.select(F.struct("subject", "strand").alias("subject"), "kmer", "s_pos"), hot=hot)
    plus = F.col("subject.strand") == "+"
    by = ["query", "subject", "diagonal"]
    diagonal = F.when(plus, F.col("s_pos") - F.col("q_pos") * 3).otherwise(F.col("s_pos") + F.col("q_pos") * 3)
    found = runs(seeds.withColumn("diagonal", diagonal), k, by).join(queries.select("query", F.length("sequence").alias("q_len")), "query")
    d, n = F.col("diagonal"), F.col("q_len") * 3
    low, high = F.when(plus, d + 3).otherwise(d - n - 2), F.when(plus, d + n + 2).otherwise(d - 3)
    blocks = pieces.select("subject", F.floor((F.col("first") - 1) / width).alias("block"), F.substring("sequence", 1, width).alias("piece"))
    reach = with_letters(found, blocks, F.col("subject.subject"), low, high, width)
    last = F.col("letters_from") + F.length("letters") - 1
    residue = F.greatest(F.lit(1), F.ceil(F.when(plus, F.col("letters_from") - d).otherwise(d - F.col("last")) / 3))
    reach = reach.withColumn("last", last).withColumn("residue", residue)
    skipped = F.when(plus, d + F.col("residue") * 3 - F.col("letters_from")).otherwise(F.col("last") - d + F.col("residue") * 3)
    wide = reach.select(*by, "q_from", "q_to", "seed_count", "letters", (~plus).alias("minus"), skipped.cast("int").alias("skip"), (1 - F.col("residue")).alias("shift"))
    aligned = wide.join(queries.select("query", F.col("sequence").alias("q_text")), "query")
    hits = extended(aligned, by, scoring, drop, _proteins)
    start, end = F.col("q_start") * 3, F.col("q_end") * 3
    places = {"s_start": F.when(plus, d + start).otherwise(d - start), "s_end": F.when(plus, d + end + 2).otherwise(d - end - 2)}
    columns = ["q_start", "q_end", "s_start", "s_end", "aln_len", "matches", "mismatches", "pct_identity", "score", "seed_count", "subject_sequence"]
    return hits.withColumns(places).select("query", "subject.subject", "subject.strand", *columns)
