"""Homology hits: types, thresholds, duplicates, tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixtable.functions import columns as C
from helixtable.schemas import HIT_DOUBLES, HIT_LONGS
from helixtable.scratch import kept


def filter_hits(hits: DataFrame, identity: float = 60.0, evalue: float = 0.01, length: int = 50, bitscore: float = 70.0) -> DataFrame:
    """Hits within all four thresholds; the conditions reach the Parquet scan."""
    return hits.where((F.col("pct_identity") >= identity) & (F.col("evalue") <= evalue) & (F.col("aln_len") >= length) & (F.col("bitscore") >= bitscore))


def typed(hits: DataFrame, doubles: list[str] = HIT_DOUBLES, longs: list[str] = HIT_LONGS) -> DataFrame:
    """Number columns cast from text; what is no number becomes null."""
    doubles, longs = ([c for c in cols if c in hits.columns] for cols in (doubles, longs))
    return hits.withColumns({c: F.col(c).try_cast("double") for c in doubles} | {c: F.col(c).try_cast("long") for c in longs})


def cast_hits(hits: DataFrame, doubles: list[str] = HIT_DOUBLES, longs: list[str] = HIT_LONGS, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Typed hits, and the rows of hits in which a number that is there could not be read. strict: such a row ends the job instead."""
    doubles, longs = ([c for c in cols if c in hits.columns] for cols in (doubles, longs))
    if strict:
        return hits.withColumns({c: F.col(c).cast("double") for c in doubles} | {c: F.col(c).cast("long") for c in longs}), hits.where(F.lit(False))
    wrong = F.lit(False)
    for c, t in [*((c, "double") for c in doubles), *((c, "long") for c in longs)]:
        wrong = wrong | (F.col(c).isNotNull() & F.col(c).try_cast(t).isNull())
    return typed(hits.where(~wrong), doubles, longs), hits.where(wrong)


def coerce_dropna(hits: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as doubles, without the rows in which one is missing or no number."""
    return hits.withColumns({c: F.col(c).try_cast("double") for c in columns}).na.drop(subset=columns)


def dedupe_hits(hits: DataFrame) -> DataFrame:
    """One of each equal row, the tag apart. Columns are grouped by, so that the shuffle has partial results only."""
    cols = [c for c in hits.columns if c != "tag"]
    return hits.select(cols).distinct()


#: Most digests of rows that are met again that dedupe_wide broadcasts, 16 bytes each.
REPEATED = 1 << 20


def dedupe_wide(hits: DataFrame) -> DataFrame:
    """dedupe_hits for wide rows, as with sequences: only rows whose 128-bit digest is met again are shuffled and compared, by all columns.

    Where more than REPEATED digests are met again, all rows are.
    """
    cols = [c for c in hits.columns if c != "tag"]
    marked = hits.select(*cols, F.struct(F.xxhash64(F.lit(1), *cols).alias("a"), F.xxhash64(F.lit(2), *cols).alias("b")).alias("_digest"))
    again = kept(marked.groupBy("_digest").count().where("count > 1").select("_digest"))
    if again.count() > REPEATED:
        return hits.select(cols).distinct()
    again = F.broadcast(again)
    return marked.join(again, "_digest", "left_anti").select(cols).union(marked.join(again, "_digest", "left_semi").select(cols).distinct())


def unique_tags(hits: DataFrame, length: int = 6) -> DataFrame:
    """hits with a tag that no different row has: the first letters of a digest, and twice as many where these are another row's too, until none are.

    Rows are brought together once, by the first letters, and sorted by their digests: of each length, those clash whose group has a least and a greatest digest
    that differ. Equal rows have one tag; null and the empty text differ.
    """
    cols = [c for c in hits.columns if c != "tag"]
    text = lambda c: F.col(c).cast("string")
    parts = F.concat(*[F.coalesce(F.concat(F.char_length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("-")) for c in cols])
    digest, lengths = F.upper(F.sha2(parts, 256)), []
    while length << len(lengths) < 64:
        lengths.append(length << len(lengths))
    # the digest is made again behind the shuffle, where its letters would be most of what moves
    near = hits.select(*cols, F.substring(digest, 1, length).alias("_head")).repartition("_head").withColumn("_digest", digest)
    heads = ["_head", *[f"_head{n}" for n in lengths[1:]]]
    near = near.withColumns({f"_head{n}": F.substring("_digest", 1, n) for n in lengths[1:]}).sortWithinPartitions(*heads)
    for i, n in enumerate(lengths):
        w = Window.partitionBy(*heads[: i + 1])
        near = near.withColumn(f"_own{n}", F.min("_digest").over(w) == F.max("_digest").over(w))
    tag = F.coalesce(*[F.when(F.col(f"_own{n}"), F.substring("_digest", 1, n)) for n in lengths], "_digest")
    return near.select(*cols, tag.alias("tag"))


def tag_hits(hits: DataFrame, length: int = 6) -> DataFrame:
    """hits with a tag from a hash of all other columns: stable when a task runs again."""
    cols = [c for c in hits.columns if c != "tag"]
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return hits.select(*cols, F.substring(F.upper(F.sha2(text, 256)), 1, length).alias("tag"))


def tag_clashes(tagged: DataFrame) -> DataFrame:
    """Tags that more than one row has."""
    return tagged.groupBy("tag").count().where("count > 1")


def extract_tags(hits: DataFrame) -> DataFrame:
    """tag out of query_id, which loses it."""
    return hits.withColumns({"tag": C.tag_of(F.col("query_id")), "query_id": C.without_tags(F.col("query_id"))})


def fasta_records(hits: DataFrame) -> DataFrame:
    """species, header and sequence (without gaps and stops) of hits with their tags."""
    return hits.select("species", C.fasta_header(F.col("subject_id"), F.col("s_start"), F.col("s_end"), F.col("tag")).alias("header"), C.ungap(F.col("subject_sequence")).alias("sequence"))


def cast_domains(domains: DataFrame) -> DataFrame:
    """bitscore as double; start and end as whole parts; what is no number becomes null."""
    return domains.withColumns({"bitscore": F.col("bitscore").try_cast("double"), "start": C.long_of(F.col("start")), "end": C.long_of(F.col("end"))})
