"""Similar sequences by shared k-mers: a seeded join and hits along diagonals."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtable.operators.lookup import wanted_kmers
from helixtable.scratch import kept

# Amino acids of the standard genetic code, codons in the order T, C, A, G of each base.
AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = dict(zip(map("".join, product("TCAG", repeat=3)), AMINO))


#: Letters of the first cut of a sequence, so that no array holds more than that many letters in short pieces.
CHUNK = 1 << 16


def _cut(df: DataFrame, keep: list[str], sequence: str, size: int, overlap: int) -> DataFrame:
    """keep, at (the letters before) and text: pieces of size + overlap letters, in time linear in the length.

    Pieces are slices of bytes, one a letter where all are ASCII and four (UTF-32) otherwise: a place in UTF-8 text costs time in
    proportion to it. The bytes are bound once, as the only entry of an array; the pieces are one array, since a generator
    copies what it does not consume to each of its rows.
    """
    s = F.col(sequence)
    narrow = F.octet_length(s) == F.char_length(s)
    raw = F.when(narrow, s.cast("binary")).otherwise(F.encode(s, "UTF-32"))
    held = F.struct(raw.alias("raw"), F.when(narrow, 1).otherwise(4).alias("w"), F.greatest(F.ceil(F.char_length(s) / size), F.lit(1)).cast("int").alias("n"))
    slices = lambda h: F.transform(
        F.sequence(F.lit(0), h["n"] - 1), lambda i: F.struct((i * size).alias("at"), F.substring(h["raw"], i * size * h["w"] + 1, (size + overlap) * h["w"]).alias("raw"), h["w"].alias("w"))
    )
    out = df.where(s.isNotNull()).select(*keep, F.explode(F.get(F.transform(F.array(held), slices), 0)).alias("c"))
    return out.select(*keep, F.col("c.at").alias("at"), F.when(F.col("c.w") == 1, F.col("c.raw").cast("string")).otherwise(F.decode("c.raw", "UTF-32")).alias("text"))


def chunked(sequences: DataFrame, size: int, overlap: int = 0, id_col: str = "seq_id", sequence: str = "sequence") -> DataFrame:
    """Pieces of at most size + overlap letters, with their first place, from 1."""
    return _cut(sequences, [id_col], sequence, size, overlap).select(id_col, (F.col("at") + 1).alias("first"), F.col("text").alias(sequence))


def kmers(sequences: DataFrame, k: int, id_col: str = "seq_id", sequence: str = "sequence", piece: int = 48) -> DataFrame:
    """id, kmer and its place (from 1) for each k-mer of each sequence: sequences are cut into chunks, these into short pieces, and both overlap."""
    chunks = _cut(sequences.where(F.length(sequence) >= k).select(F.col(id_col).alias("id"), F.col(sequence).alias("text")), ["id"], "text", CHUNK, k - 1)
    pieces = _cut(chunks.where(F.length("text") >= k).withColumnRenamed("at", "base"), ["id", "base"], "text", piece, k - 1).where(F.length("text") >= k)
    # places are generated and the letters are cut out behind, in compiled code; a function over an array would be interpreted
    places = pieces.select("id", (F.col("base") + F.col("at")).alias("base"), "text", F.explode(F.sequence(F.lit(1), F.length("text") - (k - 1))).alias("j"))
    return places.select(F.col("id").alias(id_col), F.substring("text", F.col("j"), F.lit(k)).alias("kmer"), (F.col("base") + F.col("j")).alias("pos"))


def seed_join(queries: DataFrame, subjects: DataFrame, cap: int | None = None, hot: int = 1000) -> DataFrame:
    """Pairs (query, q_pos, subject, s_pos) of equal k-mers.

    queries(query, kmer, q_pos), subjects(subject, kmer, s_pos). Only k-mers that a query has are counted, and they are
    kept, so that the subjects are cut into k-mers once. The distinct k-mers of the queries are written first: their size is known
    then, and where it is below Spark's broadcast limit the subjects' other k-mers go before any shuffle. A k-mer with more
    than hot places among the subjects is dealt to as many parts as make them hot places each, with a copy of its queries in each.
    With a cap, k-mers with more places than that are left out. A kmer may be text or a number.
    """
    asked = kept(queries.select("kmer").distinct())
    near = kept(subjects.join(asked, "kmer", "left_semi"))
    sizes = near.groupBy("kmer").count()
    if cap is not None:
        rare = sizes.where(F.col("count") <= cap).select("kmer")
        return queries.join(rare, "kmer").join(near, "kmer").select("query", "q_pos", "subject", "s_pos")
    parts = sizes.where(F.col("count") > hot).select("kmer", F.ceil(F.col("count") / hot).alias("parts"))
    dealt = near.join(parts, "kmer", "left").withColumn("salt", F.pmod(F.xxhash64("subject", "s_pos"), F.coalesce("parts", F.lit(1))))
    copies = queries.join(parts, "kmer", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    return copies.withColumn("salt", F.col("salt").cast("long")).join(dealt.withColumn("salt", F.col("salt").cast("long")), ["kmer", "salt"]).select("query", "q_pos", "subject", "s_pos")


def seeds_of(queries: DataFrame, subjects: DataFrame, k: int, hot: int = 1000) -> DataFrame:
    """Pairs (query, q_pos, subject, s_pos) of equal k-mers of queries(query, sequence) and subjects(subject, sequence).

    Subjects are cut into chunks that overlap, and where the queries have few distinct k-mers, only places of these become rows.
    """
    own = kept(kmers(queries, k, "query").withColumnRenamed("pos", "q_pos"))
    chunks = chunked(subjects, CHUNK, k - 1, "subject")
    near = wanted_kmers(chunks.select(F.struct("subject", "first").alias("chunk"), "sequence"), k, own.select("kmer").distinct(), "chunk")
    if near is None:
        places = kmers(subjects, k, "subject").withColumnRenamed("pos", "s_pos")
    else:
        places = near.select("chunk.subject", "kmer", (F.col("chunk.first") + F.col("pos") - 1).alias("s_pos"))
    return seed_join(own, places, hot=hot)


def diagonal_hits(seeds: DataFrame, min_seeds: int = 3) -> DataFrame:
    """query, subject, diagonal, seed_count and span in the subject of diagonals with enough seeds."""
    d = (F.col("s_pos") - F.col("q_pos")).alias("diagonal")
    out = seeds.groupBy("query", "subject", d).agg(F.count(F.lit(1)).alias("seed_count"), F.min("s_pos").alias("s_from"), F.max("s_pos").alias("s_to"))
    return out.where(F.col("seed_count") >= min_seeds)


def reverse_complement(dna: Column) -> Column:
    return F.translate(F.reverse(dna), "ACGT", "TGCA")


def amino(dna: Column, frame: int) -> Column:
    """Translation from base `frame` (0 to 2) on; codons with other letters give X."""
    table = F.create_map(*[F.lit(x) for pair in CODONS.items() for x in pair])
    codons = F.regexp_extract_all(F.substring(dna, frame + 1, 2**31 - 1), F.lit("(?s)..."), F.lit(0))
    return F.coalesce(F.array_join(F.transform(codons, lambda c: F.coalesce(table[c], F.lit("X"))), ""), F.lit(""))


def six_frames(sequences: DataFrame, id_col: str = "seq_id", sequence: str = "sequence") -> DataFrame:
    """id, frame (1 to 3 and -1 to -3) and protein of each sequence. Cut chromosomes into overlapping chunks first."""
    dna = F.col(sequence)
    frames = [F.struct(F.lit(f + 1).alias("frame"), amino(dna, f).alias("protein")) for f in range(3)]
    frames += [F.struct(F.lit(-f - 1).alias("frame"), amino(reverse_complement(dna), f).alias("protein")) for f in range(3)]
    return sequences.select(id_col, F.explode(F.array(*frames)).alias("x")).select(id_col, "x.frame", "x.protein")

