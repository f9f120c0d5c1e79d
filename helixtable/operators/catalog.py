"""Species lists, assemblies and the quality of FASTA files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtable.functions import columns as C


def best_assembly(reports: DataFrame) -> DataFrame:
    """taxon, accession, level: the first report at the best level, by report_index(taxon, report_index, accession, level).

    An aggregate, so that partial results are shuffled and no partition is sorted. Taxa without a known level are absent.
    """
    ranked = reports.withColumn("r", C.level_rank(F.col("level"))).where("r IS NOT NULL")
    best = F.min_by(F.struct("accession", "level"), F.struct("r", "report_index"))
    return ranked.groupBy("taxon").agg(best.alias("b")).select("taxon", "b.accession", "b.level")


def resolve_queries(queries: DataFrame, reports: DataFrame) -> DataFrame:
    """query, accession and level: an assembly accession stands for itself, other queries take their best assembly."""
    direct = queries.where(F.col("query").rlike(C.ASSEMBLY)).select("query", F.col("query").alias("accession"), F.lit("Direct_Accession").alias("level"))
    named = queries.where(~F.col("query").rlike(C.ASSEMBLY)).join(best_assembly(reports).withColumnRenamed("taxon", "query"), "query")
    return direct.unionByName(named.select("query", "accession", "level"))


def first_match(found: DataFrame) -> DataFrame:
    """term and accession: the one listed first, by rank(term, rank, accession)."""
    return found.groupBy("term").agg(F.min_by("accession", "rank").alias("accession"))


def fasta_quality(records: DataFrame) -> DataFrame:
    """For each file: records, how many have no identifier, how many identifiers it has, and whether it is fit for use."""
    empty = F.count_if(F.coalesce(F.col("seq_id"), F.lit("")) == "")
    out = records.groupBy("file").agg(F.count(F.lit(1)).alias("records"), empty.alias("empty_ids"), F.count_distinct("seq_id").alias("distinct_ids"))
    return out.withColumn("valid", (F.col("records") > 0) & (F.col("empty_ids") == 0))


def duplicate_ids(records: DataFrame) -> DataFrame:
    """file, seq_id and n of identifiers that a file has more than once; empty ones are counted by fasta_quality."""
    return records.where(F.coalesce(F.col("seq_id"), F.lit("")) != "").groupBy("file", "seq_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def fasta_verdict(records: DataFrame) -> DataFrame:
    """One row: files, how many of them are not fit for use, how many have duplicate identifiers, and whether all are fit."""
    files, twice = fasta_quality(records), duplicate_ids(records).select("file").distinct().withColumn("twice", F.lit(True))
    return files.join(twice, "file", "left").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(~F.col("valid")).alias("unfit"), F.count_if(F.coalesce("twice", F.lit(False))).alias("with_duplicates"), F.coalesce(F.bool_and("valid"), F.lit(False)).alias("all_valid")
    )
