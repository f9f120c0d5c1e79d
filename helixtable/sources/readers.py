"""Readers for sequence files, hit reports, domain reports, assembly summaries and species lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtable.functions import columns as C
from helixtable.schemas import DOMAIN_FIELDS, HIT_FIELDS, RPS_FIELDS
from helixtable.scratch import kept
from helixtable.sources.report_lines import labelled

FASTA_FILES = "*.{fa,fasta,fas,fna,FA,FASTA,FAS,FNA}"


def species_of(df: DataFrame, name: Column) -> Column:
    """The folder's species=... where files lie in such folders, else the name."""
    return F.col("species") if "species" in df.columns else name


def read_fasta(spark: SparkSession, path: str, files: str = FASTA_FILES) -> DataFrame:
    """species (folder, or file name without suffix), seq_id, description, sequence, length: one row for each record.

    Records are split by the reader, so one large file is read by many tasks. Text before the first record is no record.
    """
    raw = spark.read.option("lineSep", "\n>").option("pathGlobFilter", files).text(path)
    raw = raw.select("value", species_of(raw, C.species_from_file(F.col("_metadata.file_name"))).alias("species"))
    body = F.regexp_replace(F.regexp_replace(F.col("value"), "\r", ""), "^>", "")
    line_end = F.instr("b", "\n")
    rest = F.when(line_end > 0, F.substring(F.col("b"), line_end + 1, F.length("b"))).otherwise("")
    rows = raw.where(F.length(F.trim("value")) > 0).select("species", body.alias("b"))
    rows = rows.select("species", F.substring_index("b", "\n", 1).alias("head"), rest.alias("rest"))
    out = rows.select(
        "species",
        F.regexp_extract("head", r"^(\S*)", 1).alias("seq_id"),
        F.regexp_extract("head", r"^\S*\s+(.*)$", 1).alias("description"),
        F.regexp_replace("rest", r"\s", "").alias("sequence"),
    )
    return out.withColumn("length", F.length("sequence").cast("long"))


def _fields(spark: SparkSession, path: str, widths: tuple[int, ...], names: list[str]) -> tuple[DataFrame, DataFrame]:
    """Tab-separated lines with an accepted number of fields as strings, and the other lines."""
    raw = spark.read.text(path)
    parts = raw.where(F.length("value") > 0).select(species_of(raw, C.file_stem(F.col("_metadata.file_name"))).alias("species"), "value", F.split("value", "\t").alias("p"))
    fits = F.size("p").isin(*widths)
    rows = parts.where(fits).select(*[F.get("p", i).alias(n) for i, n in enumerate(names)], "species")
    return rows, parts.where(~fits).select("species", "value", F.concat(F.size("p").cast("string"), F.lit(" fields")).alias("reason"))


def read_blast_tab(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Hits of 12 or 13 fields (without and with the subject's sequence) as text, species from the file; and lines of other widths."""
    return _fields(spark, path, (12, 13), HIT_FIELDS)


def read_rps_tab(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Profile hits of 13 fields as text, with the tag taken out of the query id; and lines of other widths."""
    rows, odd = _fields(spark, path, (13,), RPS_FIELDS)
    return rows.select(C.without_tags(F.col("query_id")).alias("query_id"), C.tag_of(F.col("query_id")).alias("tag"), *RPS_FIELDS[1:], "species"), odd


def parse_report_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of `domains` from lines(species, file, block, value) of domain reports, in the order of the files, and the lines that could not be used.

    Lines carry the session and the query above them in their file (see report_lines.py). A DOMAINS line opens a table only as the very
    next line of a QUERY; a query without one gives a row without a domain, an empty table gives none.
    """
    df = labelled(lines.select("species", "file", "block", F.regexp_replace("value", r"^\s+|\s+$", "").alias("line")))
    parts = lambda c: F.split(c, "\t")
    df = df.select("species", "line", "in_table", "alone", "is_query", parts("line").alias("p"), parts("session").alias("s"), parts("query").alias("q"))
    in_table, alone = F.col("in_table"), F.col("alone")
    short = (in_table & (F.size("p") < 12)) | (F.col("is_query") & ~in_table & (F.size("p") < 5)) | (F.col("line").startswith("SESSION") & ~in_table & (F.size("p") < 7))
    field = lambda arr, i: F.coalesce(F.get(F.col(arr), i), F.lit(""))
    d = lambda i: F.when(in_table, field("p", i)).otherwise("")
    chromosome, start, end = C.location(field("q", 4))
    values = {
        "species": F.col("species"), "session_ordinal": F.when(in_table, field("p", 0)).otherwise(field("s", 1)),
        "program": field("s", 2), "version": field("s", 3), "database": field("s", 4), "score_matrix": field("s", 5), "evalue_threshold": field("s", 6),
        "query_id": F.when(in_table, field("p", 1)).otherwise(field("q", 1)), "seq_type": field("q", 2), "seq_length": field("q", 3), "definition": field("q", 4),
        "chromosome": chromosome, "start": start, "end": end,
        "hit_type": d(2), "pssm_id": d(3), "from": d(4), "to": d(5), "evalue": d(6), "bitscore": d(7), "accession": d(8), "domain": d(9), "incomplete": d(10), "superfamily_pssm_id": d(11),
    }
    good = df.where((in_table | alone) & ~short).select(*[values[n].alias(n) for n in DOMAIN_FIELDS], C.tag_of(field("q", 4)).alias("tag"))
    return good, df.where(short).select("species", F.col("line").alias("value"), F.concat(F.size("p").cast("string"), F.lit(" fields")).alias("reason"))


def read_domain_report(spark: SparkSession, path: str | list[str], base: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Domains of block-text reports, any number of files for each species, and the lines that could not be used.

    base: the folder above species=... folders, where path names files below it.
    """
    reader = spark.read.option("basePath", base) if base else spark.read
    raw = reader.text(path)
    meta = F.col("_metadata")
    raw = raw.select(
        species_of(raw, C.file_stem(meta["file_name"])).alias("species"), meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), "value"
    )
    return parse_report_lines(raw)


def parse_assembly_json(summaries: DataFrame) -> DataFrame:
    """taxon, report_index, accession and level of each report of summaries(taxon, json)."""
    schema = "reports array<struct<accession: string, assembly_info: struct<assembly_level: string>>>"
    raw = summaries.select("taxon", F.from_json("json", schema).alias("j")).select("taxon", F.posexplode("j.reports").alias("report_index", "r"))
    return raw.select("taxon", "report_index", F.col("r.accession").alias("accession"), F.col("r.assembly_info.assembly_level").alias("level"))


def read_assembly_json(spark: SparkSession, path: str) -> DataFrame:
    """The reports of JSON summaries, one document in each file; the taxon is the folder's taxon=... where there is one, else the file's stem."""
    whole = spark.read.text(path, wholetext=True)
    taxon = F.col("taxon") if "taxon" in whole.columns else C.file_stem(F.col("_metadata.file_name"))
    return parse_assembly_json(whole.select(taxon.alias("taxon"), F.col("value").alias("json")))


def species_from_lines(spark: SparkSession, path: str) -> DataFrame:
    """Names of a text file, one in a line, without blank lines."""
    return spark.read.text(path).where("length(value) > 0").select(F.col("value").alias("species"))


def species_from_files(spark: SparkSession, path: str, files: str = FASTA_FILES) -> DataFrame:
    """Names of the FASTA files of a folder, by the folder's species=... or the file's name; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", files).load(path)
    name = C.species_from_file(F.element_at(F.split("path", "/"), -1))
    return found.select(species_of(found, name).alias("species")).distinct()


def union_species(spark: SparkSession, path: str, names: DataFrame) -> DataFrame:
    """The rows of the listed species in a table written by species; a species without a folder (failed, or without hits) has none.

    The list prunes the folders that are read, so that others cost nothing; it is written once, and Spark broadcasts it where it is small.
    """
    return spark.read.parquet(path).join(kept(names.select("species").distinct()), "species", "left_semi")


def species_present(spark: SparkSession, path: str, default: DataFrame) -> DataFrame:
    """Distinct species of a table of hits written as CSV, or those of default if it is not there."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return default.select("species").distinct()
    return spark.read.csv(path, header=True).select("species").distinct()
