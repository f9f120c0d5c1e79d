"""FASTA line by line, for records that no single task could hold: a record comes in pieces, and may span any number of file blocks.

Every task counts records and letters of its own blocks of the files. Sums over the blocks, one row each, give the number of records and
the letters of the open record before each block; with these every line knows its record and place. Lines are then dealt to pieces
of a fixed width, each with the first letters of what follows. Files are read twice, letters are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixtable.functions import columns as C
from helixtable.scratch import kept
from helixtable.sources.readers import FASTA_FILES, species_of

WIDTH = 1024


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, int, int, str | None, int, str]]:
    """species, file, block, number of the record in the block (0 before its first header), header, place (letters of the record before, in the block) and letters."""
    block, number, head, at = None, 0, None, 0
    for b in batches:
        keys, lines = list(zip(*(b.column(c).to_pylist() for c in ("species", "file", "block")))), b.column("value")
        is_head = pc.starts_with(lines, ">").to_numpy(zero_copy_only=False)
        letters = pc.replace_substring_regex(lines, "[\t\n\x0b\x0c\r ]+", "")
        turns = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)] if keys else []
        for i, j in zip(turns, turns[1:]):
            if block != keys[i]:
                block, number, head, at = keys[i], 0, None, 0
            for k, end in _between(np.flatnonzero(is_head[i:j]) + i, i, j):
                if is_head[k]:
                    number, head, at = number + 1, lines[k].as_py()[1:], 0
                    k += 1
                text = "".join(letters.slice(k, end - k).to_pylist())
                yield *block, number, head, at, text
                at += len(text)


def _between(heads: np.ndarray, i: int, j: int) -> Iterator[tuple[int, int]]:
    """Ranges of lines from i to j, each from a header on, the first from i."""
    cuts = [i, *(h for h in heads.tolist() if h > i), j]
    return zip(cuts, cuts[1:])


def _lines(spark: SparkSession, path: str, files: str) -> DataFrame:
    raw = spark.read.option("pathGlobFilter", files).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), species_of(raw, C.species_from_file(F.col("_metadata.file_name"))).alias("species"), "value")


def _before(lines: DataFrame) -> DataFrame:
    """species, file, block, records (headers in the blocks before), open (letters of the record that goes on in this block) and open_head (its header)."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, now = [], None
        for species, file, block, number, head, at, text in _segments(batches):
            if now is None or (now["file"], now["block"]) != (file, block):
                now = {"species": species, "file": file, "block": block}
                rows.append(now)
            now |= {"heads": number, "tail": at + len(text), "head": head}
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("species", pa.string()), ("file", pa.string()), ("block", pa.int64()), ("heads", pa.int64()), ("tail", pa.int64()), ("head", pa.string())]))

    counted = kept(lines.mapInArrow(part, "species string, file string, block long, heads long, tail long, head string"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    sums = counted.withColumn("records", F.coalesce(F.sum("heads").over(before), zero)).withColumn("letters", F.coalesce(F.sum("tail").over(before), zero))
    # letters before the block in which the open record began; tails of blocks without a header add up from there on
    began = F.coalesce(F.last(F.when(F.col("heads") > 0, F.col("letters")), ignorenulls=True).over(before), zero)
    return kept(sums.select("species", "file", "block", "records", (F.col("letters") - began).alias("open"), F.last("head", ignorenulls=True).over(before).alias("open_head")))


def read_fasta_pieces(spark: SparkSession, path: str, width: int = WIDTH, overlap: int = 0, files: str = FASTA_FILES) -> DataFrame:
    """species, file, record (number in its file, from 1), seq_id, description, first and sequence: width letters from place first on, and overlap more.

    first is 1 more than a multiple of width. A record without letters is one empty piece; text before the first record is none.
    White space inside lines is left out.
    """
    lines = _lines(spark, path, files)
    fields = pa.schema([("file", pa.string()), ("block", pa.int64()), ("number", pa.int64()), ("head", pa.string()), ("at", pa.int64()), ("text", pa.string())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for row in _segments(batches):
            rows.append(row[1:])
            held += len(row[-1]) + 100
            if held > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    parts = lines.mapInArrow(part, "file string, block long, number long, head string, at long, text string")
    goes_on = F.col("number") == 0
    placed = parts.join(_before(lines), ["file", "block"]).select(
        "species", "file", (F.col("records") + F.col("number")).alias("record"), F.when(goes_on, F.col("open_head")).otherwise(F.col("head")).alias("head"), (F.col("at") + F.when(goes_on, F.col("open")).otherwise(0)).alias("at"), "text"
    )
    # bytes of a fixed width a letter, bound once for all pieces of a part
    narrow = F.octet_length("text") == F.char_length("text")
    held = F.struct(F.when(narrow, F.col("text").cast("binary")).otherwise(F.encode("text", "UTF-32")).alias("raw"), F.when(narrow, 1).otherwise(4).alias("w"), F.char_length("text").cast("long").alias("n"), "at")

    def pieces(h):
        low = F.greatest(F.lit(0).cast("long"), F.floor((h["at"] - overlap) / width))
        high = F.greatest(low, F.floor((h["at"] + h["n"] - 1) / width))

        def one(b):
            skip = F.greatest(F.lit(0).cast("long"), b * width - h["at"])
            n = F.least(h["n"], (b + 1) * width + overlap - h["at"]) - skip
            cut = F.substring(h["raw"], (skip * h["w"] + 1).cast("int"), (n * h["w"]).cast("int"))
            return F.struct(b.alias("piece"), (h["at"] + skip).alias("at"), cut.alias("raw"), h["w"].alias("w"))

        return F.transform(F.sequence(low, high), one)

    cut = placed.where("record > 0 and (text <> '' or at = 0)").select("species", "file", "record", "head", F.explode(F.get(F.transform(F.array(held), pieces), 0)).alias("p"))
    text = F.when(F.col("p.w") == 1, F.col("p.raw").cast("string")).otherwise(F.decode("p.raw", "UTF-32"))
    whole = cut.groupBy("species", "file", "record", F.col("p.piece").alias("piece")).agg(F.first("head").alias("head"), F.array_sort(F.collect_list(F.struct(F.col("p.at").alias("at"), F.octet_length("p.raw").alias("n"), text.alias("text")))).alias("t"))
    return whole.select(
        "species", "file", "record", F.regexp_extract("head", r"^(\S*)", 1).alias("seq_id"), F.regexp_extract("head", r"^\S*\s+(.*)$", 1).alias("description"),
        (F.col("piece") * width + 1).alias("first"), F.array_join(F.transform("t", lambda x: x["text"]), "").alias("sequence"),
    )
