"""Summaries: completeness and contingency of domains by species, and the frames behind their plots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixtable.functions import columns as C
from helixtable.scratch import settled

CODES = ["N", "C", "NC", "-"]


def nonempty_domain(domains: DataFrame) -> DataFrame:
    """Rows with a domain; null is not known to be empty and stays."""
    return domains.where(F.coalesce(F.length("domain") > 0, F.lit(True)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def completeness(domains: DataFrame) -> DataFrame:
    """species, domain, bitscore (mean, null if a member's is), incomplete (best code) and incomplete_desc."""
    code = F.col("incomplete")
    some = lambda v: F.coalesce(F.bool_or(code == v), F.lit(False))
    every = lambda v: F.bool_and(F.coalesce(code == v, F.lit(False)))
    best = F.when(some("-"), "W").when(some("NC"), "NC").when(some("N") & some("C"), "B").when(every("N"), "N").when(every("C"), "C")
    mean = F.when(F.count(F.lit(1)) == F.count("bitscore"), F.avg("bitscore"))
    out = domains.groupBy("species", "domain").agg(mean.alias("bitscore"), best.alias("incomplete"))
    return out.withColumn("incomplete_desc", C.completeness_label(F.col("incomplete")))


def no_hit_grid(species: DataFrame, domains: DataFrame) -> DataFrame:
    """A 'No Hit' cell for each species and each domain; both are lists of distinct names, and the product is the result."""
    cells = species.select("species").crossJoin(domains.select("domain"))
    return cells.select("species", "domain", F.lit(0.0).alias("bitscore"), F.lit("Z").alias("incomplete"), F.lit("No Hit").alias("incomplete_desc"))


def completeness_grid(domains: DataFrame, species: DataFrame, best: bool = False) -> DataFrame:
    """Found cells and No-Hit cells of all listed species, with their rank; best: one row for each cell.

    The found cells are kept, since the list of domains comes from them too: the domains are read once.
    """
    found = settled(completeness(domains))
    grid = found.unionByName(no_hit_grid(species, distinct_values(found, "domain"))).withColumn("rank", C.completeness_rank(F.col("incomplete_desc")))
    if not best:
        return grid
    first = F.min_by(F.struct("bitscore", "incomplete", "incomplete_desc", "rank"), F.coalesce("rank", F.lit(5))).alias("b")
    return grid.groupBy("species", "domain").agg(first).select("species", "domain", "b.*")


def position(df: DataFrame, column: str, name: str, descending: bool = False) -> DataFrame:
    """Distinct values of a column with their place in order, from 1. The window runs over the distinct names alone."""
    order = F.col(column).desc() if descending else F.col(column).asc()
    return df.select(column).distinct().withColumn(name, F.row_number().over(Window.orderBy(order)))


def tile_frame(grid: DataFrame) -> DataFrame:
    """The grid with each tile's label and the display order of its domain (last name first)."""
    order = position(grid, "domain", "domain_order", descending=True)
    return grid.join(order, "domain").select("species", "domain", "domain_order", "bitscore", "incomplete", "incomplete_desc", "rank", C.tile_label(F.col("incomplete")).alias("label"))


def range_counts(ranges: DataFrame) -> DataFrame:
    """Merged ranges by species, domain and code."""
    return ranges.groupBy("species", "domain", "incomplete").agg(F.count(F.lit(1)).alias("count"))


def contingency(ranges: DataFrame, ordered: bool = True) -> DataFrame:
    """Counts for all observed species x observed domains x four codes, 0 where there is no range; other codes are left out.

    The counts are kept, since both axes come from them too: the ranges are merged once.
    """
    counts = settled(range_counts(ranges))
    spark = ranges.sparkSession
    codes = spark.sql("SELECT explode(array(" + ", ".join(f"'{c}'" for c in CODES) + ")) AS incomplete")
    cells = counts.select("species").distinct().crossJoin(counts.select("domain").distinct()).crossJoin(F.broadcast(codes))
    n, c = counts.alias("n"), cells.alias("c")
    on = F.col("c.species").eqNullSafe(F.col("n.species")) & F.col("c.domain").eqNullSafe(F.col("n.domain")) & (F.col("c.incomplete") == F.col("n.incomplete"))
    out = c.join(n, on, "left").select("c.species", "c.domain", C.contingency_label(F.col("c.incomplete")).alias("incomplete"), F.coalesce(F.col("n.count"), F.lit(0).cast("long")).alias("count"))
    return out.orderBy("species", "domain", "incomplete") if ordered else out


def _place(label: Column) -> Column:
    return F.when(label == "Complete", 1).when(label == "N-Truncated", 2).when(label == "C-Truncated", 3).when(label == "Bitruncated", 4)


def scatter_frame(table: DataFrame) -> DataFrame:
    """Non-zero cells of a contingency with axis places, hover text and marker size."""
    cells = table.where("count > 0")
    text = F.concat_ws(
        " ", F.lit("Species:"), "species", F.lit("<br>"), F.lit("Domain:"), "domain", F.lit("<br>"), F.lit("Incomplete:"), "incomplete", F.lit("<br>"), F.lit("Count:"), F.col("count").cast("string")
    )
    placed = cells.join(position(cells, "species", "x"), "species").join(position(cells, "domain", "y"), "domain")
    return placed.select("species", "domain", "incomplete", "count", "x", "y", _place(F.col("incomplete")).alias("z"), text.alias("hover"), (F.sqrt("count") * 3).alias("size"))


def missing_species(listed: DataFrame, found: DataFrame) -> DataFrame:
    """Listed species without any row in found."""
    return listed.select("species").join(found.select("species"), "species", "left_anti")


def species_intersect(listed: DataFrame, found: DataFrame) -> DataFrame:
    return listed.select("species").intersect(found.select("species"))
