"""Hits from seeds: extension along diagonals without gaps, with scores, identity and thresholds.

Seeds on one diagonal that overlap or touch are one run of equal letters. A run is extended to both sides over the query's and the
subject's letters until the score falls by more than a given drop below the best so far, and ends at that best; a task does
that for many runs at once, as running sums and maxima of arrays. Of a diagonal's hits, one
that lies within another goes.

Subjects come in blocks of a fixed width, so that one may be as long as a chromosome: a run takes the blocks that its query
can reach on its diagonal, and no more than these are held together. Queries are held whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixtable.operators.lookup import code_points
from helixtable.operators.seeds import chunked

WIDTH = 1024


@dataclass(frozen=True)
class Scoring:
    """What a pair of letters scores: equal ones, different ones of one class, and others. Unknown letters never match.

    table gives single pairs (both letters as one text, in both orders) their own scores, as those of a published matrix.
    """

    match: int = 5
    mismatch: int = -4
    similar: int = -4
    classes: tuple[str, ...] = ()
    unknown: str = ""
    table: dict[str, int] = field(default_factory=dict)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of pairs of letters, given as code points, and whether they match."""
        known = ~np.isin(a, [ord(c) for c in self.unknown]) if self.unknown else np.ones(len(a), dtype=bool)
        equal = (a == b) & known
        alike = np.zeros(len(a), dtype=bool)
        for letters in self.classes:
            members = [ord(c) for c in letters]
            alike |= np.isin(a, members) & np.isin(b, members)
        scores = np.where(equal, self.match, np.where(alike & known, self.similar, self.mismatch)).astype(np.int64)
        if self.table:
            keys = np.array([ord(x) << 32 | ord(y) for x, y in self.table], dtype=np.uint64)
            order = np.argsort(keys)
            own = a << np.uint64(32) | b
            near = np.minimum(np.searchsorted(keys, own, sorter=order), len(keys) - 1)
            given = keys[order][near] == own
            scores[given] = np.array(list(self.table.values()), dtype=np.int64)[order][near][given]
        return scores, equal


#: Residues of similar nature; X stands for any.
PROTEIN = Scoring(match=5, mismatch=-4, similar=1, classes=("ILMV", "FWY", "HKR", "DENQ", "AGPST"), unknown="X")


def blocks_of(subjects: DataFrame, width: int = WIDTH) -> DataFrame:
    """subject, block (from 0) and piece: all letters of subjects(subject, sequence) in blocks of width letters."""
    return chunked(subjects, width, 0, "subject").select("subject", F.floor((F.col("first") - 1) / width).alias("block"), F.col("sequence").alias("piece"))


def runs(seeds: DataFrame, k: int, by: list[str]) -> DataFrame:
    """by, q_from, q_to and seed_count of the runs of seeds(by, q_pos) that overlap or touch. by holds the diagonal, so a group is no longer than a query."""
    w = Window.partitionBy(*by).orderBy("q_pos")
    new = F.coalesce(F.col("q_pos") > F.lag("q_pos").over(w) + k, F.lit(True))
    numbered = seeds.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(w))
    return numbered.groupBy(*by, "run").agg(F.min("q_pos").alias("q_from"), (F.max("q_pos") + (k - 1)).alias("q_to"), F.count(F.lit(1)).alias("seed_count")).drop("run")


def with_letters(df: DataFrame, blocks: DataFrame, subject: Column, low: Column, high: Column, width: int = WIDTH) -> DataFrame:
    """df with letters_from and letters: the subject's letters from low (1 at least) to high, as far as there are any. Rows of df differ."""
    near = df.withColumn("_subject", subject).withColumn("letters_from", F.greatest(low, F.lit(1)).cast("long")).withColumn("_to", high.cast("long"))
    block = lambda c: F.floor((F.col(c) - 1) / width)
    asked = near.withColumn("block", F.explode(F.sequence(block("letters_from"), block("_to"))))
    found = asked.join(blocks.select(F.col("subject").alias("_subject"), "block", "piece"), ["_subject", "block"])
    # of a block, only the letters in reach go on
    skip = F.greatest(F.col("letters_from") - F.col("block") * width, F.lit(1))
    part = F.substring("piece", skip.cast("int"), (F.col("_to") - F.col("block") * width - skip + 1).cast("int"))
    joined = found.select(*near.columns, F.struct("block", part.alias("part")).alias("p")).groupBy(*near.columns).agg(F.array_sort(F.collect_list("p")).alias("p"))
    return joined.withColumn("letters", F.array_join(F.transform("p", lambda p: p["part"]), "")).drop("p", "_subject", "_to")


HIT = ["q_start", "q_end", "score", "aln_len", "matches", "subject_sequence"]
#: Pairs of letters that a task holds at a time, but for a longer query.
CELLS = 1 << 20


def _best(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, step: int, drop: int) -> tuple[np.ndarray, np.ndarray]:
    """Letters and score of the best prefix of each segment of scores (backwards with step -1), looked for until the sum is more than drop below the best."""
    width = int(lengths.max(initial=0)) + 1
    i = np.arange(width)
    inside = i < lengths[:, None]
    # what lies behind a segment ends it
    sums = np.cumsum(np.where(inside, scores[np.where(inside, starts[:, None] + step * i, 0)], -(drop + 1) * (1 << 20)), axis=1)
    top = np.maximum.accumulate(np.maximum(sums, 0), axis=1)
    alive = np.cumsum(top - sums > drop, axis=1) == 0
    sums = np.where(alive, sums, 0)
    at = np.argmax(sums, axis=1)
    best = np.take_along_axis(sums, at[:, None], axis=1)[:, 0]
    return np.where(best > 0, at + 1, 0), np.maximum(best, 0)


def _extensions(rows: list[tuple], scoring: Scoring, drop: int) -> Iterator[np.ndarray | list[str]]:
    """q_start, q_end, score, aln_len, matches and subject_sequence of rows(q_from, q_to, q_text, s_text, shift)."""
    q_from, q_to, _, _, shift = (np.array(c) if i in (0, 1, 4) else None for i, c in enumerate(zip(*rows)))
    first = np.maximum(1, 1 - shift)
    n = np.minimum([len(r[2]) for r in rows], np.array([len(r[3]) for r in rows]) - shift) - first + 1
    a = "".join(r[2][f - 1 : f - 1 + m] for r, f, m in zip(rows, first.tolist(), n.tolist()))
    theirs = [r[3][f + d - 1 : f + d - 1 + m] for r, f, d, m in zip(rows, first.tolist(), shift.tolist(), n.tolist())]
    scores, equal = scoring.pairs(code_points(a), code_points("".join(theirs)))
    scores = np.append(scores, 0)
    base = np.cumsum(n) - n
    low, high = base + q_from - first, base + q_to - first + 1  # the run's letters among all
    left, left_score = _best(scores, low - 1, q_from - first, -1, drop)
    right, right_score = _best(scores, high, n - (q_to - first + 1), 1, drop)
    total, same = np.concatenate([[0], np.cumsum(scores)]), np.concatenate([[0], np.cumsum(equal)])
    yield q_from - left
    yield q_to + right
    yield total[high] - total[low] + left_score + right_score
    yield high + right - low + left
    yield same[high + right] - same[low - left]
    yield [t[i:j] for t, i, j in zip(theirs, (low - left - base).tolist(), (high + right - base).tolist())]


def extended(aligned: DataFrame, by: list[str], scoring: Scoring, drop: int, read: Callable[[pa.RecordBatch], list[str]] | None = None) -> DataFrame:
    """by, q_start, q_end, seed_count, score, aln_len, matches, mismatches, pct_identity and subject_sequence of the hits.

    aligned(by, q_from, q_to, seed_count, q_text, s_text, shift): letter r of the query lies on letter r + shift of s_text. Unknown letters count as mismatches.
    read: gives the letters instead of s_text, from all columns of a batch of aligned.
    """
    keep = [*by, "q_from", "seed_count"]
    fields = ", ".join(f"`{c}` {aligned.schema[c].dataType.simpleString()}" for c in keep)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, at, cells = [], 0, 0
            q_from, q_to, q_text, shift = (b.column(c).to_pylist() for c in ("q_from", "q_to", "q_text", "shift"))
            for i, row in enumerate(zip(q_from, q_to, q_text, read(b) if read else b.column("s_text").to_pylist(), shift)):
                rows.append(row)
                cells = max(cells, len(row[2]) + 1)
                if cells * len(rows) >= CELLS or i + 1 == b.num_rows:
                    found = [pa.array(x) for x in _extensions(rows, scoring, drop)]
                    yield pa.RecordBatch.from_arrays([*(b.column(c).slice(at, len(rows)) for c in keep), *found], names=[*keep, *HIT])
                    rows, at, cells = [], i + 1, 0

    wide = aligned if read else aligned.select(*keep, "q_to", "q_text", "s_text", "shift")
    df = wide.mapInArrow(part, f"{fields}, q_start long, q_end long, score long, aln_len long, matches long, subject_sequence string")
    w = Window.partitionBy(*by).orderBy("q_start", F.desc("q_end"), "q_from")
    reached = F.max("q_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("own", F.coalesce(reached < F.col("q_end"), F.lit(True))).withColumn("hit", F.sum(F.col("own").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # a hit that lies within others lies within the last one before it: its seeds count there
    df = df.withColumn("seed_count", F.sum("seed_count").over(Window.partitionBy(*by, "hit"))).where("own")
    identity = F.col("matches") * 100.0 / F.col("aln_len")
    return df.withColumns({"mismatches": F.col("aln_len") - F.col("matches"), "pct_identity": identity}).drop("own", "hit", "q_from")


def within(hits: DataFrame, identity: float = 60.0, length: int = 50, score: int = 70) -> DataFrame:
    """Hits within the thresholds of identity, aligned length and raw score."""
    return hits.where((F.col("pct_identity") >= identity) & (F.col("aln_len") >= length) & (F.col("score") >= score))


def extend_seeds(seeds: DataFrame, queries: DataFrame, blocks: DataFrame, k: int, scoring: Scoring = Scoring(), drop: int = 20, width: int = WIDTH) -> DataFrame:
    """query, subject, q_start, q_end, s_start, s_end, aln_len, matches, mismatches, pct_identity, score, seed_count, subject_sequence.

    seeds(query, q_pos, subject, s_pos) of k letters, queries(query, sequence), one row each, and blocks of the subjects as blocks_of() gives them. A hit is one for
    each (query, subject, diagonal, place); equal seeds count once each. Without seeds there are no rows.
    """
    by = ["query", "subject", "diagonal"]
    lengths = queries.select("query", F.length("sequence").alias("q_len"))
    found = runs(seeds.withColumn("diagonal", (F.col("s_pos") - F.col("q_pos")).cast("long")), k, by).join(lengths, "query")
    reach = with_letters(found, blocks, F.col("subject"), F.col("diagonal") + 1, F.col("diagonal") + F.col("q_len"), width)
    aligned = reach.join(queries.select("query", F.col("sequence").alias("q_text")), "query").withColumnRenamed("letters", "s_text")
    hits = extended(aligned.withColumn("shift", F.col("diagonal") - F.col("letters_from") + 1), by, scoring, drop)
    places = {"s_start": F.col("q_start") + F.col("diagonal"), "s_end": F.col("q_end") + F.col("diagonal")}
    return hits.withColumns(places).select("query", "subject", "q_start", "q_end", "s_start", "s_end", "aln_len", "matches", "mismatches", "pct_identity", "score", "seed_count", "subject_sequence")
