"""Near copies by SimHash, completed by word shingles: texts whose sets of SHINGLE-word shingles have a Jaccard similarity of at least SIMILARITY.

SimHash fingerprints of these shingles link each text to the closest ones that a multi-index finds, which are verified
on their whole sets. Fingerprints of near copies may differ by more bits than an index can look up, so texts that are in different groups
after that are compared further.

Exact, by prefixes: under any common order of all shingles, two sets of that similarity share one among the first
n - ceil(SIMILARITY n) + 1 of each. The order puts shingles that a sample of documents has often last, so that few
documents meet under a key; another sample gives another order and the same links. Candidates are verified on their
whole sets.

A key that many documents share is not paired out: its members are compared with REPS of them first (those that share most keys), and only those that
are in different groups then are paired. Their links connect the same documents as all pairs would.

Defined results: words are separated by ASCII white space and compared without regard to ASCII case; a text of fewer words
than a shingle is one shingle; null and blank texts are copies of each other; equal texts (by 64-bit hash) enter the
search once; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtable.llm.common import SPACE, components, fresh, settled, stash
from helixtable.llm.simhash import closest, shingle_hashes, with_fingerprints

SHINGLE, SIMILARITY = 5, 0.8
SAMPLE, SHARE, COMMON, REPS, ROWS, FEW = 4000, 8, 500_000, 4, 1000, 200_000


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles of a text as signed 64-bit numbers, in order."""
    return np.unique(np.frombuffer(shingle_hashes(text, SHINGLE), dtype=">i8").astype(np.int64))


def node_of(text: Column) -> Column:
    """The hash that stands for a text; one for all blank texts."""
    return F.xxhash64(F.when(F.btrim(text, F.lit(SPACE)) != "", text).otherwise(""))


def _sets(texts: DataFrame) -> DataFrame:
    """node and s, its shingles, for texts(node, text)."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                b = batch.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([shingles(t.as_py()) for t in b.column("text")], pa.list_(pa.int64()))], names=["node", "s"])

    return texts.select("node", "text").mapInArrow(part, "node long, s array<long>")


def common_shingles(texts: DataFrame, sample: int = SAMPLE, share: int = SHARE) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that documents share, in order, and about how many documents have each; at most COMMON of each kind.

    First those that a sample of about `sample` documents has more than once. Then, of the keys that the order so far gives to one of
    `share` documents, those that occur there more than once: with them last, the number of documents that meet under a
    key does not grow with the corpus where they share no more than a passage.
    """
    n = texts.count()

    def counted(rows: DataFrame, every: int) -> pa.Table:
        often = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        return often.orderBy(F.desc("n"), "h").limit(COMMON).select("h", (F.col("n") * every).alias("n")).toArrow()

    part = lambda every: texts.where(F.pmod("node", F.lit(every)) == 0)
    every = max(1, n // sample)
    often = counted(_sets(part(every)).select(F.explode("s").alias("h")), every).sort_by("h")
    known = often["h"].to_numpy(), often["n"].to_numpy()
    every = max(1, min(share, n // sample))
    more = counted(prefixes(part(every), known, SIMILARITY).select(F.col("key").alias("h")), every)
    both = pa.concat_tables([often, more]).group_by("h").aggregate([("n", "max")]).sort_by("h")
    return both["h"].to_numpy(), both["n_max"].to_numpy()


def prefixes(texts: DataFrame, common: tuple[np.ndarray, np.ndarray], similarity: float) -> DataFrame:
    """node, n (shingles of the text), key (a shingle of its prefix) and pos (its place in the order, from 0)."""
    shared = texts.sparkSession.sparkContext.broadcast(common)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, counts = shared.value
        for batch in batches:
            nodes, column = batch.column("node").to_numpy(zero_copy_only=False), batch.column("text")
            for at in range(0, batch.num_rows, ROWS):
                keys, sizes = [np.empty(0, np.int64)], []
                for t in column[at : at + ROWS]:
                    s = shingles(t.as_py())
                    if len(often) and len(s):
                        i = np.minimum(np.searchsorted(often, s), len(often) - 1)
                        s = s[np.lexsort((s, np.where(often[i] == s, counts[i], 0)))]
                    keys.append(s[: len(s) - ceil(similarity * len(s) - 1e-9) + 1] if len(s) else s)
                    sizes.append(len(s))
                taken = [len(k) for k in keys[1:]]
                cols = [np.repeat(nodes[at : at + ROWS], taken), np.repeat(np.array(sizes, np.int32), taken), np.concatenate(keys), np.concatenate([np.empty(0, np.int32), *[np.arange(k, dtype=np.int32) for k in taken]])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["node", "n", "key", "pos"])

    return texts.select("node", "text").mapInArrow(part, "node long, n int, key long, pos int")


def _may(similarity: float, a: str, b: str) -> Column:
    """Whether two entries of a key can belong to a pair that meets there first: by sizes, and by what follows the key."""
    n, m, i, j = (F.col(f"{x}.{c}") for c in ("n", "pos") for x in (a, b))
    need = F.lit(similarity / (1 + similarity)) * (n + m) - 1e-6
    return (F.least(n, m) >= F.greatest(n, m) * similarity - 1e-6) & (F.least(n - i, m - j) >= need)


def _pairs(left: DataFrame, right: DataFrame, other: Column, similarity: float) -> DataFrame:
    """Distinct pairs a < b, with components ca and cb, of entries o of left and x of right that share a key."""
    side = lambda x: F.struct(F.col(f"{x}.node").alias("node"), F.col(f"{x}.component").alias("component"))
    met = left.alias("o").join(right.alias("x"), (F.col("o.key") == F.col("x.key")) & other & _may(similarity, "o", "x"))
    met = met.select(F.least(side("o"), side("x")).alias("a"), F.greatest(side("o"), side("x")).alias("b"))
    return met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.component").alias("ca"), F.col("b.component").alias("cb")).distinct()


def _few(df: DataFrame) -> DataFrame:
    """df (a settled list of numbers), to be broadcast where a count says that it has at most FEW rows."""
    return F.broadcast(df) if df.count() <= FEW else df


def _packed(texts: DataFrame) -> DataFrame:
    """node and z, its text compressed, once for each node of texts(node, text)."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shrink = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            z = pa.array([shrink((t.as_py() or "").encode()) for t in b.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("node"), z], names=["node", "z"])

    return texts.select("node", "text").mapInArrow(part, "node long, z binary").groupBy("node").agg(F.first("z").alias("z"))


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a settled table) whose whole sets are as similar as asked.

    Texts travel compressed, at a quarter of the size of their sets, which are made where a pair has met.
    """
    asked = settled(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    packed = stash(_packed(texts.join(_few(asked), "node", "left_semi")))
    side = lambda x: packed.select(F.col("node").alias(x), F.col("z").alias(f"z{x}"))
    names = pairs.columns

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, known = zstandard.ZstdDecompressor().decompress, {}

        def set_of(z: bytes) -> np.ndarray:
            if z not in known:
                if len(known) >= 32:
                    known.pop(next(iter(known)))
                known[z] = shingles(expand(z).decode())
            return known[z]

        for b in batches:
            keep = []
            for za, zb in zip(b.column("za"), b.column("zb")):
                x, y = set_of(za.as_py()), set_of(zb.as_py())
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(same > 0 and same / (len(x) + len(y) - same) >= similarity)
            yield b.select(names).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select(*names, "za", "zb")
    return both.mapInArrow(part, ", ".join(f"{c} long" for c in names))


def simhash_links(texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) of nodes of texts(node, text): those of one fingerprint to the least of them, and these to the closest fingerprints', where verified."""
    nodes = settled(with_fingerprints(texts, ["node"], SHINGLE).groupBy("node").agg(F.first("fp").alias("fp")))
    fps = settled(nodes.groupBy("fp").agg(F.min("node").alias("head")))
    same = nodes.join(fps, "fp").where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    head = lambda x: fps.select(F.col("fp").alias(x), F.col("head").alias(f"h{x}"))
    near = closest(fps.select("fp")).join(head("a"), "a").join(head("b"), "b").select(F.col("ha").alias("a"), F.col("hb").alias("b"))
    pairs = settled(same.union(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return _verified(pairs, texts, similarity)


def groups(texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """node and component of the nodes of texts(node, text) that are linked to another; all others are alone."""
    near = settled(simhash_links(texts, similarity))
    named = settled(components(None, near))
    entries = stash(prefixes(texts, common_shingles(texts), similarity))
    shared = settled(entries.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key"))
    buckets = entries.join(_few(shared), "key", "left_semi").distinct().join(_few(named), "node", "left")
    buckets = stash(buckets.withColumn("component", F.coalesce("component", "node")))

    # a text with few changes of its own shares the most keys and is near to most of its group: of each key, the best of
    # all, of either half by hash, and one by chance
    shares = buckets.groupBy("node").agg((-F.count(F.lit(1))).alias("shares"))
    half = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(2))
    orders = [[F.col("shares")], [half, F.col("shares")], [-half, F.col("shares")], [F.lit(0)]][:REPS]
    first = [F.min(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.xxhash64("node"), "node", "n", "pos", "component")) for order in orders]
    entry = [F.struct(*[f[c].alias(c) for c in ("node", "n", "pos", "component")]) for f in first]
    reps = buckets.join(shares, "node").groupBy("key").agg(F.array_distinct(F.array(*entry)).alias("r")).select("key", F.explode("r").alias("r")).select("key", "r.*")
    pairs = settled(_pairs(reps, buckets, F.col("o.component") != F.col("x.component"), similarity))
    links = settled(_verified(pairs, texts, similarity).select("a", "b"))
    named = components(None, near.union(links))

    now = buckets.drop("component").join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = now.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    now = stash(now.join(apart, "key", "left_semi"))
    rest = _pairs(now, now, (F.col("o.node") < F.col("x.node")) & (F.col("o.component") != F.col("x.component")), similarity)
    rest = settled(rest.join(pairs.select("a", "b"), ["a", "b"], "left_anti"))
    joined = components(None, _verified(rest, texts, similarity).select(F.col("ca").alias("a"), F.col("cb").alias("b")))

    joined = settled(joined.withColumnRenamed("node", "first"))
    after = named.withColumnRenamed("component", "first").join(joined, "first", "left").select("node", F.coalesce("component", "first").alias("component"))
    alone = joined.withColumnRenamed("first", "node").join(named.select("node"), "node", "left_anti")  # linked to others by the second links only
    return after.unionByName(alone)


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each group of near copies, with the columns of docs: the one with the smallest doc_id (nulls last, then by text hash).

    Rows that repeat the identifier and the text of the one that stays go too. Texts are not moved for this where few
    documents go: their names are broadcast then.
    """
    own = fresh(docs, "near_copy")
    name = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("k"), F.xxhash64("text").alias("text"))
    rows = docs.select(node_of(F.col("text")).alias("node"), name.alias(own))
    named = groups(docs.select(node_of(F.col("text")).alias("node"), "text"), similarity)
    rows = settled(rows.groupBy(own).agg(F.first("node").alias("node"), F.count(F.lit(1)).alias("n")).join(named, "node", "left").select(own, "n", F.coalesce("component", "node").alias("component")))
    best = settled(rows.groupBy("component").agg(F.min(own).alias("best"), F.count(F.lit(1)).alias("names")).where("names > 1").select("component", "best"))
    gone = settled(rows.join(_few(best), "component").where(F.col(own) != F.col("best")).select(own))
    again = settled(rows.where("n > 1").select(own).join(gone, own, "left_anti"))
    keyed = docs.withColumn(own, name)
    out = keyed.join(_few(gone), own, "left_anti")
    if again.limit(1).count():
        once = out.join(_few(again), own, "left_semi").dropDuplicates([own])
        out = out.join(_few(again), own, "left_anti").unionByName(once)
    return out.select(docs.columns)
