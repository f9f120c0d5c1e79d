"""Writers: Parquet, delimited text, FASTA and GFF3 by species, provenance."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtable.schemas import DOMAIN_FIELDS
from helixtable.scratch import kept_meanwhile, removed, shuffles_dropped


def _unless_empty(df: DataFrame, path: str, mode: str, written: DataFrame | None = None) -> bool:
    """Whether a written table has rows; one without is taken away again, so that df is computed once only.

    Nothing is taken away after an append, as the rows that were there before are not known.
    """
    spark = df.sparkSession
    try:
        empty = (spark.read.parquet(path) if written is None else written).isEmpty()
    except AnalysisException as e:  # a table in folders without any folder has no schema
        if e.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        empty = True
    if empty and mode != "append":
        removed(spark, path)
    return not empty


def _dealt(df: DataFrame, by: str) -> DataFrame:
    """Rows of one value of by together, in parts of Spark's advisory size: few files a folder, and many tasks for a large one."""
    return df.hint("rebalance", by)


def write_parquet(df: DataFrame, path: str, by: str | None = "species", mode: str = "errorifexists") -> bool:
    """df as Parquet, in folders by species; nothing for an empty table. Whether it wrote, as for all writers of tables."""
    if by:
        _dealt(df, by).write.mode(mode).partitionBy(by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)
    return _unless_empty(df, path, mode)


def _write_delimited(df: DataFrame, path: str, mode: str, sep: str) -> bool:
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)
    lines = ", ".join(f"`{c}` string" for c in df.columns)
    return _unless_empty(df, path, mode, df.sparkSession.read.schema(lines).option("sep", sep).csv(path, header=True))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> bool:
    return _write_delimited(df, path, mode, ",")


def write_tsv(domains: DataFrame, path: str, fields: list[str] = DOMAIN_FIELDS, mode: str = "errorifexists") -> bool:
    """Tab-separated with a header, in the order of fields."""
    return _write_delimited(domains.select(fields), path, mode, "\t")


def decimal_commas(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.translate(F.col(c).cast("string"), ".", ",") for c, t in df.dtypes if t in ("double", "float") or t.startswith("decimal")})


def write_csv2(df: DataFrame, path: str, mode: str = "errorifexists") -> bool:
    """Semicolons between fields and commas in decimals."""
    return _write_delimited(decimal_commas(df), path, mode, ";")


def wrapped(sequence: Column, width: int = 60) -> Column:
    return F.regexp_replace(sequence, f"(.{{{width}}})(?=.)", "$1\n")


def write_fasta(records: DataFrame, path: str, mode: str = "errorifexists") -> bool:
    """records(species, header, sequence) as FASTA in a folder for each species, lines of 60 letters."""
    text = F.concat(F.lit(">"), "header", F.lit("\n"), wrapped(F.col("sequence")))
    _dealt(records.select("species", text.alias("value")), "species").write.mode(mode).partitionBy("species").text(path)
    return _unless_empty(records, path, mode, records.sparkSession.read.text(path))


#: The columns that GFF3 lines are made of, in the order by which they are sorted.
GFF3_ORDER = ["species", "chromosome", "start", "end", "strand", "domain", "incomplete", "mean_bitscore"]


def escaped(value: Column) -> Column:
    """Reserved characters of GFF3 attributes, as %XX."""
    out = F.replace(value, F.lit("%"), F.lit("%25"))
    for c in "\t\n\r;=&,":
        out = F.replace(out, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return F.when(value.rlike(r"[%\t\n\r;=&,]"), out).otherwise(value)  # most values have none


def gff3_line(source: str = "helixtable") -> Column:
    """The GFF3 line of a range."""
    attributes = [F.concat(F.lit(f"{n}="), escaped(F.coalesce(F.col(n).cast("string"), F.lit("NA")))) for n in ("species", "domain", "incomplete", "mean_bitscore")]
    fields = [F.col("chromosome"), F.lit(source), F.lit("sequence_feature"), F.col("start").cast("string"), F.col("end").cast("string"), F.lit("."), F.col("strand"), F.lit("."), F.concat_ws(";", *attributes)]
    return F.concat_ws("\t", *fields)


def write_gff3(ranges: DataFrame, path: str, mode: str = "errorifexists") -> bool:
    """A folder for each species, the version line first and ranges in the order of GFF3_ORDER.

    Rows are dealt by ranges of species and place, so a large species is written by many tasks: its files, in the order of their
    names, are one GFF3 file, and the first of them has the version line. A small species is one file. The ranges are written once before,
    so that the samples for the dealing do not compute them again, and taken away at the end. Only the tasks that write the files make
    lines of them, which are longer and are neither kept nor shuffled.
    """
    spark = ranges.sparkSession
    with kept_meanwhile(ranges.select(GFF3_ORDER)) as rows, shuffles_dropped(spark):
        head = [F.lit(None).cast(rows.schema[n].dataType).alias(n) for n in GFF3_ORDER[1:]]
        heads = rows.select(F.nullif("species", F.lit("")).alias("species")).distinct().select("species", *head, F.lit(0).alias("_line"))
        order = ["species", "_line", *GFF3_ORDER[1:]]
        both = heads.unionByName(rows.withColumn("_line", F.lit(1))).repartitionByRange(*order).sortWithinPartitions(*order)
        value = F.when(F.col("_line") == 0, "##gff-version 3").otherwise(gff3_line())
        both.select("species", value.alias("value")).write.mode(mode).partitionBy("species").text(path)
    return _unless_empty(ranges, path, mode, spark.read.text(path))


def append_provenance(df: DataFrame, path: str) -> None:
    """df(query, accession, level) appended to a tab-separated log."""
    df.select("query", "accession", "level").write.mode("append").option("sep", "\t").csv(path)
