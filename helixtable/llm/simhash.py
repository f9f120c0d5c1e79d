"""SimHash near-duplicates by multi-index hashing.

Fingerprints have 64 bits. Two fingerprints within 2 bits differ by at most 1 bit in the high half or by none in the low
half, so each fingerprint probes a table of high halves with the ball of radius 1 around its own (33 keys) and a table of low
halves with its own value. Matches are verified on complete fingerprints.

A table key that more than HOT different fingerprints share is resolved exactly without comparing all its pairs: its
members enumerate the ball of radius 1 in the other half too, and probes one bit away in this half bring their exact
other half. Rows that meet under such a key are within 2 bits of each other, and links to the least of them connect the same
documents as all pairs would.

Defined results: a null or blank text has fingerprint zero, which links like any other; texts are taken whole; equal
texts share a fingerprint and enter the search once; null identifiers never become a component's identifier unless it
has no other; an empty table gives an empty table; of the other columns, clusters() keeps those asked for, and results
replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh64_digest

from helixtable.llm.common import components, fresh, settled

SEED, SHINGLE, BITS, HOT = 42, 3, 2, 32
#: Bits within which closest() looks, and the parts of a fingerprint that it looks up: lowest bit and width.
WIDE, PARTS = 5, ((0, 22), (22, 21), (43, 21))


def shingle_hashes(text: str | None, size: int) -> bytes:
    """The 64-bit hashes of a text's word shingles, one after the other; a shorter text is one shingle, a blank one has none."""
    ws = (text or "").encode().lower().split()  # bytes: lower() and split() know ASCII alone
    if not ws:
        return b""
    line = b" ".join(ws)
    if len(ws) < size:
        return xxh64_digest(line, SEED)
    at = [0, *accumulate(len(w) + 1 for w in ws)]
    return b"".join([xxh64_digest(line[a : b - 1], SEED) for a, b in zip(at, at[size:])])


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Bit majority over the hashes of a text's word shingles, as a signed 64-bit number."""
    hashes = shingle_hashes(text, size)
    if not hashes:
        return 0
    h = np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 65536):
        ones += np.unpackbits(h[i : i + 65536], axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big", signed=True)


def with_fingerprints(docs: DataFrame, keep: list[str], size: int = SHINGLE) -> DataFrame:
    """The columns in keep and fp (long), of shingles of size words."""

    own = fresh(docs, "text_of_row")

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(t.as_py(), size) for t in b.column(own)], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), fp], names=[*keep, "fp"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col("text").alias(own)).mapInArrow(part, f"{fields}, fp long")


def _ball(value: Column, width: int = 32) -> Column:
    """The value and all values of that width one bit away."""
    return F.array(value, *[value.bitwiseXOR(F.lit(1 << i)) for i in range(width)])


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect all fingerprints of fps(fp long, unique) within BITS bits of each other."""
    half = F.lit(1 << 32)
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit((1 << 32) - 1))
    # keys of the two tables in one number: high halves as they are, low halves above 2^32
    entries = fps.select("fp", F.explode(F.array(high, low + half)).alias("key"))
    sizes = entries.groupBy("key").count()
    hot = settled(sizes.where(F.col("count") > HOT).select("key", F.lit(1).alias("hot")))
    probes = fps.select("fp", F.explode(F.concat(_ball(high), F.array(low + half))).alias("key")).join(hot, "key", "left")
    table = entries.join(hot, "key", "left_anti").withColumnRenamed("fp", "other")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= BITS
    plain = probes.where("hot is null").join(table, "key").where(near & (F.col("fp") != F.col("other"))).select(F.col("fp").alias("a"), F.col("other").alias("b"))

    in_high = F.col("key") < half
    member = F.when(in_high, F.col("key") == high).otherwise(True)
    other = F.when(in_high, low).otherwise(high)
    deep = probes.where("hot is not null").select("fp", "key", F.explode(F.when(member, _ball(other)).otherwise(F.array(other))).alias("sub"))
    heads = deep.groupBy("key", "sub").agg(F.min("fp").alias("other"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    star = deep.join(heads, ["key", "sub"]).where(near & (F.col("fp") != F.col("other"))).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    return plain.union(star)


def closest(fps: DataFrame) -> DataFrame:
    """Links (a, b) from each fingerprint of fps(fp long, unique) to the closest and to the least of those found within WIDE bits of it.

    Of the three parts one differs by at most a bit then, so each is looked up with its ball of radius 1. A key brings HOT fingerprints at
    most, so that a crowded one costs its size times HOT: links are lost there alone, and who needs all of them has an exact step behind.
    """
    # a part's number stands above its bits, so that the keys of all are one table
    keys = [F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1)) + F.lit(i << 32) for i, (low, width) in enumerate(PARTS)]
    balls = [_ball(key, width) for key, (_, width) in zip(keys, PARTS)]
    place = F.row_number().over(Window.partitionBy("key").orderBy("other"))
    table = fps.select(F.col("fp").alias("other"), F.explode(F.array(*keys)).alias("key")).withColumn("place", place).where(F.col("place") <= HOT).drop("place")
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    met = fps.select("fp", F.explode(F.concat(*balls)).alias("key")).join(table, "key").where((apart <= WIDE) & (F.col("fp") != F.col("other")))
    found = met.groupBy("fp").agg(F.min(F.struct(apart.alias("bits"), "other"))["other"].alias("near"), F.min("other").alias("least"))
    return found.select(F.col("fp").alias("a"), F.explode(F.array_distinct(F.array("near", "least"))).alias("b"))


def clusters(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns in keep, fp, component (least fp of the group) and component_id (smallest doc_id reachable by links)."""
    keep = [c for c in keep if c not in ("fp", "component", "component_id")]
    rows = settled(with_fingerprints(docs, list(dict.fromkeys(["doc_id", *keep]))))
    fps = settled(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    groups = components(fps.select(F.col("fp").alias("node")), links(fps.select("fp")))
    named = groups.join(fps, groups.node == fps.fp).select("fp", "component", "least")
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(ids, "component").select("fp", "component", "component_id"), "fp").select(*keep, "fp", "component", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, with the columns of docs: the one with the smallest doc_id (nulls last, then by text hash)."""
    own = fresh(docs, "simhash_name")  # a doc_id may stand for several texts
    key = docs.withColumn(own, F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("k"), F.xxhash64("text").alias("hash")))
    best = clusters(key, [own]).groupBy("component").agg(F.min(own).alias(own)).select(own)
    return key.join(best, own, "left_semi").dropDuplicates([own]).select(docs.columns)
