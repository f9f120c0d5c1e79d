"""Genomic ranges: strand, order of coordinates, merging with mean scores.

Coordinates are closed and start at 1. Ranges are flat columns, so that filters and partitioning apply to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixtable.functions import columns as C
from helixtable.scratch import kept

#: Bases of a bin in which one task merges the ranges of a group.
BIN = 1 << 20
GROUP = ["species", "domain", "incomplete", "chromosome", "strand"]


def normalize(domains: DataFrame, start: str = "start_pos", end: str = "end_pos") -> DataFrame:
    """chromosome as its accession, strand from the given order, then start and end in order."""
    low, high = C.ordered(F.col(start), F.col(end))
    keep = [c for c in domains.columns if c not in ("chromosome", "strand", "start", "end", start, end)]
    return domains.select(*keep, C.accession(F.col("chromosome")).alias("chromosome"), C.strand(F.col(start), F.col(end)).alias("strand"), low.alias("start"), high.alias("end"))


def split_valid(ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ranges that can be merged, and those without a chromosome or a coordinate."""
    good = F.col("chromosome").isNotNull() & F.col("start").isNotNull() & F.col("end").isNotNull()
    return ranges.where(good), ranges.where(~good)


def _islands(df: DataFrame, keys: list[str], min_gap: int, sums: list) -> DataFrame:
    """Merges within keys: a range opens an island where it starts beyond the greatest end so far plus min_gap."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("start") > reach + min_gap), 1).otherwise(0)
    df = df.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return df.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"), *sums).drop("_island")


def _reaching(rows: DataFrame, min_gap: int, size: int) -> DataFrame:
    """_h, _g, _bin and _reach: how far ranges of earlier bins reach, for the bins that they reach or touch. Only ranges that cross an edge count, and islands do for their ranges."""
    crossing = rows.where(F.col("end") + min_gap >= (F.col("_bin") + 1) * size).groupBy("_g", "_bin").agg(F.max("end").alias("_reach"))
    met = F.explode(F.sequence(F.col("_bin") + 1, F.floor((F.col("_reach") + min_gap) / size)))
    reached = crossing.select("_g", met.alias("_bin"), "_reach").groupBy("_g", "_bin").agg(F.max("_reach").alias("_reach"))
    return reached.select(F.xxhash64("_g", "_bin").alias("_h"), "*")


def _stitched(islands: DataFrame, reaching: DataFrame, min_gap: int, size: int, sums: list) -> DataFrame:
    """Islands of bins (_h, _g, _bin) merged over the edges of the bins; only those at edges move.

    What earlier bins reach is one island with whatever reaches so far, so a bin has at most two rows to stitch: all its islands that are
    reached, and the last one where that goes beyond the bin without being reached. The join and the first grouping keep the bins' partitioning.
    """
    df = islands.join(reaching, ["_h", "_g", "_bin"], "left")
    reached = F.coalesce(F.col("start") <= F.col("_reach") + min_gap, F.lit(False))
    edge = reached | (F.col("end") + min_gap >= (F.col("_bin") + 1) * size)
    merged = [F.min("start").alias("start"), F.max("end").alias("end"), *sums]
    edges = df.where(edge).withColumn("_reached", reached).groupBy("_h", "_g", "_bin", "_reached").agg(*merged)
    moved = _islands(edges.drop("_bin", "_reached").withColumn("_h", F.xxhash64("_g")), ["_h", "_g"], min_gap, sums)
    return df.where(~edge).select(moved.columns).union(moved)


def reduce_ranges(ranges: DataFrame, by: list[str] = GROUP, min_gap: int = 1, bin_size: int | None = BIN) -> DataFrame:
    """Overlapping or touching ranges of a group as one, with the mean bitscore and the number of members.

    The mean is null if a member's score is. Ranges are merged within bins of their starts, of bin_size bases, and the islands at the bins'
    edges then over these, with sums and counts travelling along: no task needs more of a group than a bin, or two
    rows for each of its bins. The bins' islands are written once, and whether any crosses an edge is found out from them; where none does, they are the result.
    With bin_size=None one window runs over each whole group. Ranges without a chromosome or a coordinate are not merged: see split_valid().
    """
    valid, _ = split_valid(ranges)
    # groups are compared as structs, which are equal also where they hold nulls
    rows = valid.select(F.struct(*by).alias("_g"), "start", "end", "bitscore")
    score = [F.col("bitscore").cast("double").alias("_s"), F.col("bitscore").isNull().cast("long").alias("_nulls"), F.lit(1).cast("long").alias("_n")]
    sums = [F.sum("_s").alias("_s"), F.sum("_nulls").alias("_nulls"), F.sum("_n").alias("_n")]
    if bin_size:
        h = F.xxhash64("_g", "_bin").alias("_h")
        # what follows from other columns is neither shuffled nor written
        dealt = rows.withColumn("_bin", F.floor(F.col("start") / bin_size)).repartition("_g", "_bin")
        merged = kept(_islands(dealt.select(h, "_g", "_bin", "start", "end", *score), ["_h", "_g", "_bin"], min_gap, sums).drop("_h")).select(h, "*")
        reaching = kept(_reaching(merged, min_gap, bin_size))
        if reaching.limit(1).count():
            merged = _stitched(merged, reaching, min_gap, bin_size, sums)
    else:
        merged = _islands(rows.repartition("_g").select(F.xxhash64("_g").alias("_h"), "_g", "start", "end", *score), ["_h", "_g"], min_gap, sums)
    return merged.select(
        *[F.col("_g")[c].alias(c) for c in by], "start", "end", (F.col("end") - F.col("start") + 1).alias("width"), F.when(F.col("_nulls") == 0, F.col("_s") / F.col("_n")).alias("mean_bitscore"), F.col("_n").alias("members")
    )


def merge_ranges(ranges: DataFrame, by: list[str] = GROUP, min_gap: int = 1, bin_size: int | None = BIN) -> tuple[DataFrame, DataFrame]:
    """Merged ranges, and the rows that could not be merged, as they are."""
    return reduce_ranges(ranges, by, min_gap, bin_size), split_valid(ranges)[1]
