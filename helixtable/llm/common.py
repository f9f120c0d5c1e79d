"""Shared helpers: words, row keys, scratch tables and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, as characters and as a Java regular expression.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"

#: Most rows of two numbers that components() broadcasts, or holds in one partition.
JUMPS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; empty for null or blank texts."""
    inner = F.btrim(text, F.lit(SPACE))
    return F.when(inner != "", F.split(inner, SPACES)).otherwise(F.array().cast("array<string>"))


def n_words(text: Column) -> Column:
    """Number of words, 0 for null. Blanks are squeezed to one byte, so that lengths give the count without an array."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batch in parts with at most about `most` bytes of a text or binary column each (a longer value alone), so that few texts are held at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints; where a local session names none (tests), a temporary one is set."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not given:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        given = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", given)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(given)
    return given


def settled(df: DataFrame) -> DataFrame:
    """df written once to the shared folder (a reliable checkpoint), so that a lost executor costs a read, not a recomputation. For narrow tables."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stash(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read again: compressed, and later steps read only the columns they use. For wide tables."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stash-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(nodes: DataFrame | None, links: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest node reachable from each node: columns node and component; without nodes, those of linked nodes alone.

    nodes: column node (long, unique). links: columns a, b (longs among the nodes), in any direction, repeats allowed.
    Each round takes the smallest label among the linked nodes (a partial aggregate before the shuffle) and then jumps
    to the label's own label, so that long chains shrink geometrically. Nodes without links never enter the rounds.

    Labels that have moved themselves are few near the end and never those of settled components, whose members so need no jump:
    only they are joined to the members, as a broadcast where a count says that they are at most JUMPS. Where a count says
    that all links are at most JUMPS, the rounds have one partition and broadcast joins, so that none shuffles.
    """
    both = links.where(F.col("a") != F.col("b"))
    both = settled(both.select("a", "b").union(both.select(F.col("b"), F.col("a"))).distinct())
    few = both.count() <= JUMPS
    settle, side = (lambda df: settled(df).coalesce(1), F.broadcast) if few else (settled, lambda df: df)
    both = both.coalesce(1) if few else both
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    for _ in range(rounds):
        near = both.join(side(labels), both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = settle(labels.join(side(near), "node").select("node", F.least("label", "near").alias("to"), "label"))
        # where labels lead: the least one that each label in use has itself now
        roots = step.select("to").distinct().join(side(step.select(F.col("node").alias("to"), F.col("to").alias("far"))), "to").where("far < to")
        n = roots.count()
        moved = step.withColumn("far", F.col("to")) if not n else step.join(F.broadcast(roots) if n <= JUMPS else roots, "to", "left")
        labels = moved.select("node", F.least("to", F.coalesce("far", "to")).alias("now"), "label")
        if not n and not step.where("to <> label").limit(1).count():
            labels = labels.select("node", F.col("now").alias("label"))
            break
        labels = settle(labels.select("node", F.col("now").alias("label")))
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    named = labels.select("node", F.col("label").alias("component"))
    return named if nodes is None else nodes.join(named, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
