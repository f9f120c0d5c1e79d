"""Exact deduplication by content-defined chunk recipes.

Texts are equal when they are the same after each run of white space is replaced by one space. A text is cut where a rolling hash
of its last 32 bytes says so, so that equal texts are cut alike wherever they lie. A chunk is named by a 128-bit identifier,
and a text by the ordered list of its chunks' identifiers, its recipe: texts are equal if their recipes are.

Identifiers are verified: one that is met once names one chunk; of those met again, the chunks' bytes are compared, and where
two different chunks share one, all texts are named anew by another hash. Bytes move for that alone, each chunk at
most once and merged before the shuffle; everything else moves identifiers, 16 bytes for some 4 KB of text. Which chunks are met
again is told by a bitmap of 2**MARK_BITS words, broadcast; when that fills up, more chunks are moved and compared, with the same result.

Groups of equal texts are merged before their shuffle. A group with more than one row in HOT of all rows gets its rows by a broadcast
of those groups, of which there are at most HOT; the others by a join on recipes.

Defined results: a null text counts as empty; a text of white space alone equals another of that kind and not the empty one; of
rows with one identifier and equal texts exactly one is kept; null identifiers come last, so a null keep_id stands for a group without
any other; an identifier may be of any type that sorts; repeated rows count in group_size; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtable.llm.common import fresh, settled, slices, stash

#: Least, usual and largest bytes of a chunk; the usual size is a power of two above the least.
LEAST, USUAL, MOST = 1024, 4096, 32768
WINDOW, BLOCK = 32, 1 << 20
MARK_BITS = 20
HOT = 4096
#: Most identifiers (of 8 bytes, two for a chunk) of a recipe that is broadcast.
SHORT = 128
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 1) for b in range(256)], dtype=np.uint32)


def normalized(text: Column) -> Column:
    """Each run of white space as one space; single spaces are not touched."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of a text end."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    buf, ends, last = np.frombuffer(data, dtype=np.uint8), [], 0
    for at in range(0, n, BLOCK):
        back = min(at, WINDOW - 1)
        h = GEAR[buf[at - back : at + BLOCK]]
        for k in (1, 2, 4, 8, 16):  # a hash of 2k bytes from two of k
            h[k:] = h[k:] + (h[:-k] << np.uint32(k))
        for end in (np.flatnonzero(h[back:] < np.uint32(2**32 // (USUAL - LEAST))) + at + 1).tolist():
            while end - last > MOST:
                last += MOST
                ends.append(last)
            if end - last >= LEAST:
                last = end
                ends.append(last)
    while n - last > MOST:
        last += MOST
        ends.append(last)
    return ends if last == n else [*ends, n]


def chunks(data: bytes) -> Iterator[bytes]:
    at = 0
    for end in chunk_ends(data):
        yield data[at:end]
        at = end


def _identifier(chunk: bytes, bits: int, seed: int) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(chunk, seed) & ((1 << bits) - 1)
    # the first number is spread over all its values also where few bits are taken
    hi, lo = h >> 64 if bits > 64 else (h * 0x9E3779B97F4A7C15) % 2**64, h % 2**64
    return hi - (hi >> 63 << 64), lo - (lo >> 63 << 64)


def _recipes(docs: DataFrame, id_col: str, text_col: str, bits: int, seed: int) -> DataFrame:
    """id, row, sha (of the normalised text), hi and lo (the chunks' identifiers), on the shared folder."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for batch in batches for x in slices(batch, "text")):
            sha, his, los = [], [], []
            for t in b.column("text"):
                data = t.as_py()
                ids = [_identifier(c, bits, seed) for c in chunks(data)]
                sha.append(hashlib.sha256(data).digest())
                his.append([i[0] for i in ids])
                los.append([i[1] for i in ids])
            new = [pa.array(sha, pa.binary()), pa.array(his, pa.list_(pa.int64())), pa.array(los, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("row"), *new], names=["id", "row", "sha", "hi", "lo"])

    given = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), normalized(F.col(text_col)).cast("binary").alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    return stash(given.mapInArrow(part, f"id {kind}, row long, sha binary, hi array<long>, lo array<long>"))


def _verified(docs: DataFrame, text_col: str, recipes: DataFrame, bits: int, seed: int) -> bool:
    """Whether no two different chunks share an identifier: the bytes of all chunks whose identifiers are met again are compared."""
    ids = recipes.select(F.explode(F.arrays_zip("hi", "lo")).alias("c")).groupBy("c.hi", "c.lo").count()
    word = F.shiftrightunsigned("hi", 64 - MARK_BITS)
    bit = F.shiftrightunsigned("hi", 58 - MARK_BITS).bitwiseAND(F.lit(63))
    again = ids.where("count > 1").select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int")).alias("bit"))
    marks = settled(again.groupBy("word").agg(F.bit_or("bit").alias("bits")))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for batch in batches for x in slices(batch, "text")):
            found = [c for t in b.column("text") for c in chunks(t.as_py())]
            ids = [_identifier(c, bits, seed) for c in found]
            yield pa.RecordBatch.from_arrays([pa.array([i[0] for i in ids], pa.int64()), pa.array([i[1] for i in ids], pa.int64()), pa.array(found, pa.binary())], names=["hi", "lo", "chunk"])

    cut = docs.select(normalized(F.col(text_col)).cast("binary").alias("text")).mapInArrow(part, "hi long, lo long, chunk binary")
    # at most 2**MARK_BITS rows of two numbers
    near = cut.withColumn("word", word).join(F.broadcast(marks), "word").where(F.call_function("shiftright", F.col("bits"), bit.cast("int")).bitwiseAND(F.lit(1)) == 1)
    contents = near.groupBy("hi", "lo", "chunk").agg(F.count(F.lit(1)).alias("n"))
    return not contents.groupBy("hi", "lo").count().where("count > 1").limit(1).count()


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 128) -> DataFrame:
    """id, row (a number of its own), sha, hi and lo: the chunks' verified identifiers, in order, of each row of docs.

    bits: of the first identifiers; they are doubled up to 128, and then the hash is changed, until no two chunks share one.
    """
    for seed in range(16):
        found = _recipes(docs, id_col, text_col, bits, seed)
        if _verified(docs, text_col, found, bits, seed):
            return found
        bits = min(128, bits * 2)
    raise RuntimeError("different chunks share an identifier under 16 hashes")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 128) -> DataFrame:
    """The identifier with keep_id (that of the row that stays of the equal texts), group_size, kept and text_sha256, one row for each of docs."""
    rows = recipes(docs, id_col, text_col, bits).withColumn("key", F.xxhash64("hi", "lo"))
    on = ["key", "hi", "lo"]
    stays = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("stays")
    groups = settled(rows.groupBy(*on).agg(stays, F.count(F.lit(1)).alias("group_size")).where("group_size > 1").select(*on, F.col("stays.id").alias("keep_id"), F.col("stays.row").alias("keep_row"), "group_size"))
    large = (F.col("group_size") > rows.count() // HOT) & (F.size("hi") * 2 <= SHORT)
    hot = F.broadcast(groups.where(large))
    new = ["id", "row", "sha", "keep_id", "keep_row", "group_size"]
    # groups are rows of more than a HOT-th of all rows, so at most HOT of at most SHORT numbers
    out = rows.join(hot, on).select(*new).union(rows.join(hot.select(*on), on, "left_anti").join(groups.where(~large), on, "left").select(*new))
    alone = F.col("keep_row").isNull()
    return out.select(
        F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(alone, True).otherwise(F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with the columns of docs: of rows with one identifier and equal texts, which differ in other columns, any."""
    i, sha = fresh(docs, "kept_id"), fresh(docs, "kept_sha")
    stay = exact_groups(docs, id_col, text_col).where("kept").select(F.struct(F.col(id_col)).alias(i), F.col("text_sha256").alias(sha))
    named = docs.withColumn(i, F.struct(F.col(id_col))).withColumn(sha, F.sha2(normalized(F.col(text_col)).cast("binary"), 256))
    return named.join(stay, [i, sha], "left_semi").dropDuplicates([i, sha]).select(docs.columns)


#: DuckDB SQL for exact_groups over the table documents.
SQL = r"""
WITH texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
grouped AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM texts)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM grouped
"""
