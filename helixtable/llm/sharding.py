"""Minimax contiguous sharding, in DataFrame functions only.

Rows with equal texts form one atomic group. Groups are ordered by the 64-bit hash of their text; shards are contiguous
in that order, and the capacity is the smallest for which greedy filling needs no more than the given number of shards.

A row's shard then depends on its hash and the cuts alone, so no row is sorted or moved to be assigned. The greedy check
runs on the driver over a summary of bounded size: the order is cut into ranges by leading hash bits, and only ranges in
which a cut can still fall are split further, until those hold single groups. About the same number of ranges is live
at each level whatever the size of the corpus.

Defined results: a null text counts as an empty one and is in its group; a group larger than an even
share gets a shard that is as large as needed, and the other shards share the rest about equally; an empty table gives an empty table; equal rows get different slots; further
columns are left out by assign() and kept by shard_documents(), where results replace columns of the same name.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixtable.llm.common import settled

FIRST_BITS, MORE_BITS, ROWS_PER_SLOT_BLOCK = 12, 6, 20_000


def fill(sizes: list[int], shards: int, capacity: int) -> list[int] | None:
    """First item of each shard when shards are filled in order up to capacity; None if that takes more than shards."""
    ends = list(accumulate(sizes, initial=0))
    starts, at = [], 0
    while at < len(sizes):
        if len(starts) == shards:
            return None
        starts.append(at)
        after = bisect_right(ends, ends[at] + capacity) - 1
        if after == at:
            return None
        at = after
    return starts


def smallest_capacity(sizes: list[int], shards: int, low: int) -> int:
    """Binary search for the smallest feasible capacity that is at least low."""
    high = max(low, max(sizes, default=0), -(-sum(sizes) // shards) + max(sizes, default=0))
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fill(sizes, shards, mid) is not None else (mid + 1, high)
    return low


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """(capacity, least hash of each shard) for groups(h long, bytes long), h unique.

    Ranges are kept as (least hash, bytes, groups, range number, bits). Taking ranges as atomic gives a feasible capacity,
    and an even share or the largest group a bound from below; a cut k lies between the positions that these two allow.
    """
    unsigned = F.col("h").bitwiseXOR(F.lit(-(2**63)))  # leading bits then follow the signed order

    def ranges(df: DataFrame, bits: int) -> list[tuple[int, int, int, int, int]]:
        key = F.shiftrightunsigned(unsigned, 64 - bits)
        rows = df.groupBy(key.alias("r")).agg(F.min("h"), F.sum("bytes"), F.count(F.lit(1)), F.max("bytes")).collect()
        return sorted((r[1], r[2], r[3], r[0], bits, r[4]) for r in rows)

    parts = ranges(groups, FIRST_BITS)
    if not parts:
        return 0, []
    total, largest = sum(p[1] for p in parts), max(p[5] for p in parts)
    low = max(largest, -(-total // shards))
    while True:
        sizes = [p[1] for p in parts]
        high = smallest_capacity(sizes, shards, low)
        ends = list(accumulate(sizes))
        live, near = set(), 0
        for k in range(1, shards):  # where cut k can fall: the least and the greatest position after k shards
            i = bisect_right(ends, near + low)
            near = ends[i - 1] if i and ends[i - 1] > near else near  # a range that straddles may give nothing
            far = min(total, k * high)
            first, last = bisect_right(ends, near), bisect_right(ends, far)
            live.update(i for i in range(first, min(last + 1, len(parts))) if parts[i][2] > 1)
        if high == low or not live:
            return high, [parts[i][0] for i in fill(sizes, shards, high)]
        deep = {}
        for i in live:
            deep.setdefault(parts[i][4], []).append(parts[i][3])
        split = []
        for bits, keys in deep.items():
            wanted = groups.where(F.shiftrightunsigned(unsigned, 64 - bits).isin(keys)) if len(keys) <= 200 else groups.join(
                F.broadcast(groups.sparkSession.createDataFrame([(k,) for k in keys], "r long")), F.shiftrightunsigned(unsigned, 64 - bits) == F.col("r"), "left_semi"
            )
            split += ranges(wanted, min(64, bits + MORE_BITS))
        parts = sorted([p for i, p in enumerate(parts) if i not in live] + split)


def balanced_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """minimax_cuts(), with the shards beside an oversized group near equal too.

    A group larger than an even share sets the capacity alone, and greedy filling would load all other shards up to it. The
    groups before and after it are then cut by the same search over the other shards, divided by bytes, if that does not
    raise the capacity.
    """
    capacity, cuts = minimax_cuts(groups, shards)
    total, largest, h = groups.agg(F.sum("bytes"), F.max("bytes"), F.max_by("h", F.struct("bytes", "h"))).first()
    if not cuts or capacity != largest or largest * shards <= total:
        return capacity, cuts
    before, after = groups.where(F.col("h") < h), groups.where(F.col("h") > h)
    b1 = before.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    b2 = total - largest - b1
    least, most = int(b1 > 0), shards - 1 - int(b2 > 0)
    if least > most or b1 + b2 == 0:
        return capacity, cuts
    mine = max(least, min(most, round((shards - 1) * b1 / (b1 + b2))))
    c1, k1 = balanced_cuts(before, mine) if b1 else (0, [])
    c2, k2 = balanced_cuts(after, shards - 1 - mine) if b2 else (0, [])
    return (capacity, [*k1, h, *k2]) if max(c1, c2) <= capacity else (capacity, cuts)


def assign(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 8), text_crc32, law, shard, slot, grown_shard (null: the law is bytes).

    Slots number the rows of a shard from 0 without gaps: rows are dealt to blocks by hash of identifier and text, a
    window ranks each block, and the blocks' counts give the offsets. A hot text or source spreads over all blocks.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = settled(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            F.xxhash64("doc_id", "text").alias("u"),
        )
    )
    groups = settled(rows.groupBy("h").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")))
    _, cuts = balanced_cuts(groups, shards)
    n = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, -(-n // (shards * ROWS_PER_SLOT_BLOCK)))
    shard = sum(((F.col("h") >= F.lit(c)).cast("int") for c in cuts[1:]), F.lit(0))
    rows = rows.select("*", shard.cast("int").alias("shard"), F.pmod("u", F.lit(blocks)).cast("int").alias("block"))
    counts = rows.groupBy("shard", "block").count()
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("shard", "block").orderBy("u", "doc_id", "text_crc32"))
    return (
        rows.withColumn("rank", rank)
        .join(offsets, ["shard", "block"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("rank") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """docs with the column shard, e.g. for write.partitionBy('shard'); rows are not shuffled."""
    h = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select(h.alias("h"), (F.octet_length(F.coalesce("text", F.lit(""))) + 8).alias("size"))
    _, cuts = balanced_cuts(settled(rows.groupBy("h").agg(F.sum("size").cast("long").alias("bytes"))), shards)
    return docs.withColumn("shard", sum(((h >= F.lit(c)).cast("int") for c in cuts[1:]), F.lit(0)).cast("int"))
