"""Species as units of work: one that cannot be read is left out and reported, and the others go on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtable.operators.hits import typed
from helixtable.schemas import HIT_DOUBLES, HIT_LONGS
from helixtable.scratch import kept


def _reason(df: DataFrame, doubles: list[str], longs: list[str]) -> Column:
    """The first of the columns whose value is there and no number, with the value; else null."""
    wrong = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.concat(F.lit(f"{c}: "), F.col(c))) for t, cols in (("double", doubles), ("long", longs)) for c in cols]
    return F.coalesce(*wrong) if wrong else F.lit(None).cast("string")


def cast_by_species(hits: DataFrame, doubles: list[str] = HIT_DOUBLES, longs: list[str] = HIT_LONGS) -> tuple[DataFrame, DataFrame]:
    """Typed hits of the species all of whose numbers can be read; and species, rows, bad_rows, reason (the least in text order) of all of them.

    One bad value rejects its species. The counts are one row a species, written once, so that Spark knows whether they are few enough to be broadcast. A null species is one of its own.
    """
    doubles, longs = ([c for c in cols if c in hits.columns] for cols in (doubles, longs))
    checked = hits.select("species", _reason(hits, doubles, longs).alias("reason"))
    counts = kept(checked.groupBy("species").agg(F.count(F.lit(1)).alias("rows"), F.count("reason").alias("bad_rows"), F.min("reason").alias("reason")))
    bad = counts.where("bad_rows > 0").select(F.col("species").alias("_rejected"))
    good = hits.join(bad, F.col("species").eqNullSafe(F.col("_rejected")), "left_anti")
    return typed(good, doubles, longs), counts


def union_with_report(hits: DataFrame, names: DataFrame, doubles: list[str] = HIT_DOUBLES, longs: list[str] = HIT_LONGS) -> tuple[DataFrame, DataFrame]:
    """Typed rows of the listed species without the rejected ones; and one row for each listed name: species, status, rows, bad_rows, reason.

    status is taken, rejected (a value is no number; its rows are left out) or missing (no rows). Names that repeat count once, rows of species that are not
    listed go nowhere. Where hits is a table written by species, the list prunes the folders that are read.
    """
    listed = kept(names.select("species").distinct())
    good, counts = cast_by_species(hits.join(listed, "species", "left_semi"), doubles, longs)
    report = listed.join(counts, "species", "left")
    status = F.when(F.col("rows").isNull(), "missing").when(F.col("bad_rows") > 0, "rejected").otherwise("taken")
    zero = F.lit(0).cast("long")
    return good, report.select("species", status.alias("status"), F.coalesce("rows", zero).alias("rows"), F.coalesce("bad_rows", zero).alias("bad_rows"), "reason")
