"""Near-duplicate vectors by NN-descent.

Equal vectors are one node. A node's sketch is 128 bits, the sides of random hyperplanes on which its vector lies; the share of
differing bits estimates the angle between two vectors. Only sketches (16 bytes) travel through the search:

1. Nodes that share a bucket in one of several random-hyperplane tables give the first neighbour lists. The number of tables is
   taken from the chance to miss a pair just at the threshold. Buckets of more than BUCKET nodes are compared in blocks.
2. Rounds of neighbours-of-neighbours joins refine the lists until few change. A node that is in very many lists is joined with
   the nodes that list it in groups of bounded size.
3. A list full of possible links is saturated: it is enlarged, to twice and four times its size, by further joins.
4. Possible links are checked on the vectors, in double precision. A node whose enlarged list is still full is one of a dense
   core: all its links are counted by comparing blocks of its component's members, nearby ones together. Centres and radii
   decide most pairs of blocks without a comparison; the others are compared, and a block sends one count for each of
   its rows, not pairs.
5. An audit compares a bounded sample of nodes with all nodes by brute force; where too few of its links were found, further
   tables are added and the rounds repeat, and the job fails if the last attempt has too few.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components link with nothing; vectors of different lengths do
not link; equal vectors (by 128 bits of hash) link with each other; repeated rows count as vectors of their own; rows with a null vec_id take
part and never name a component unless it has no other name, and are not kept then; an empty table gives an empty table;
further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtable.llm.common import components, settled

K, ENLARGED, TABLES, LEAF, BUCKET, BLOCK, MEET = 10, 40, 4, 4096, 16_384, 512, 256
ROUNDS, STEADY, SAMPLE, RECALL, RETRIES, MISS = 6, 0.005, 512, 0.99, 2, 0.001
BITS, SIGMAS = 128, 4.4
PAIRS = "a long, b long, ham int"


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of rows that come sorted by keys (integers), also across batches."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cut = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
        for s, e in zip([0, *cut], [*cut, batch.num_rows]):
            k = tuple(int(c[s]) for c in cols)
            if held and k != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = k
            held.append(batch.slice(s, e - s))
    if held:
        yield key, pa.Table.from_batches(held)


def units(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision."""
    x = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]).astype(np.float64).reshape(len(column), -1)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def most_bits(cosine: float) -> int:
    """Differing sketch bits that a pair of that cosine stays within, but for a chance of about 5 in a million."""
    p = acos(cosine) / pi
    return ceil(BITS * p + SIGMAS * sqrt(BITS * p * (1 - p)))


def tables_for(n: int, threshold: float, leaf: int = LEAF) -> int:
    """Tables in which a pair just at the threshold shares no bucket with a chance of at most MISS; TABLES at least."""
    hit = (1 - acos(threshold) / pi) ** table_bits(n, leaf)
    return max(TABLES, ceil(log(MISS) / log(1 - hit))) if hit < 1 else TABLES


def table_bits(n: int, leaf: int) -> int:
    return max(1, ceil(log2(max(2, n / leaf))))


def sketched(nodes: DataFrame, tables: int, bits: int, seed: int) -> DataFrame:
    """node, s (two longs) and codes (a bucket in each table) of nodes(node, vec)."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            for (dim,), t in groups(iter([b]), ["dim"]):
                if dim not in planes:  # the sketches' planes do not depend on the seed
                    planes[dim] = np.concatenate([np.random.default_rng([0, dim]).normal(size=(dim, BITS)), np.random.default_rng([1, seed, dim]).normal(size=(dim, tables * bits))], axis=1)
                sides = units(t["vec"]) @ planes[dim] > 0
                s = np.packbits(sides[:, :BITS], axis=1).view(np.int64).reshape(-1)
                codes = (sides[:, BITS:].reshape(-1, tables, bits).astype(np.int64) << np.arange(bits)).sum(axis=2) * 65536 + dim % 65536
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), k).cast(pa.list_(pa.int64())) for x, k in ((s, 2), (codes.reshape(-1), tables))]
                yield pa.RecordBatch.from_arrays([t["node"].combine_chunks(), *lists], names=["node", "s", "codes"])

    return nodes.select("node", "vec", F.size("vec").alias("dim")).mapInArrow(part, "node long, s array<long>, codes array<long>")


def _near(ids: np.ndarray, s: np.ndarray, ids2: np.ndarray, s2: np.ndarray, k: int, most: int) -> Iterator[pa.RecordBatch]:
    """PAIRS of each row with its k nearest others on the right within `most` bits."""
    step = max(1, 2_000_000 // max(1, len(ids2)))
    for at in range(0, len(ids), step):
        a = ids[at : at + step]
        ham = sum(np.bitwise_count(s[at : at + step, None, w] ^ s2[None, :, w]).astype(np.int16) for w in range(BITS // 64))
        ham[a[:, None] == ids2[None, :]] = BITS + 1
        row, col = np.nonzero(ham <= most)
        d = ham[row, col]
        if len(row):
            mixed = (ids2[col].astype(np.uint64) + a[row].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)  # equals are taken by chance, so that no node is in all lists
            order = np.lexsort((mixed, d, row))
            row, col, d = row[order], col[order], d[order]
            first = np.searchsorted(row, row)  # the k nearest of each row
            keep = np.arange(len(row)) - first < k
            yield pa.RecordBatch.from_arrays([pa.array(a[row[keep]]), pa.array(ids2[col[keep]]), pa.array(d[keep].astype(np.int32))], names=["a", "b", "ham"])


def _sketches(t: pa.Table) -> np.ndarray:
    return np.stack([t["s1"].to_numpy(), t["s2"].to_numpy()], axis=1).view(np.uint64)


def _nearest_in_groups(df: DataFrame, keys: list[str], k: int, most: int) -> DataFrame:
    """PAIRS among the rows (node, s1, s2, mine, other) of each group; rows with different parts are compared over the parts only."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in groups(batches, keys):
            if t.num_rows > 1:
                ids, s, mine = t["node"].to_numpy(), _sketches(t), t["mine"].to_numpy()
                low = mine == mine.min()
                if low.all():
                    yield from _near(ids, s, ids, s, k, most)
                else:
                    yield from _near(ids[low], s[low], ids[~low], s[~low], k, most)
                    yield from _near(ids[~low], s[~low], ids[low], s[low], k, most)

    return df.select(*keys, "node", "s1", "s2", "mine").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(part, PAIRS)


def _in_blocks(rows: DataFrame, keys: list[str], sizes: DataFrame, block: int) -> DataFrame:
    """rows with the pair of parts (i, j) of their group for which they are compared, and which part is theirs (mine).

    sizes: keys and count of the groups of more than `block` rows. Such a group has about count / block parts.
    """
    df = rows.join(F.broadcast(sizes) if sizes.count() <= 10_000 else sizes, keys, "left")
    parts = F.ceil(F.coalesce("count", F.lit(1)) / block).cast("int")
    df = df.withColumn("mine", F.pmod(F.xxhash64("node"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return df.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")}).drop("count", "other")


def bucket_pairs(nodes: DataFrame, n: int, k: int, most: int, seed: int, tables: int, leaf: int = LEAF) -> DataFrame:
    """PAIRS of nodes that share a bucket in a table; buckets of more than BUCKET nodes are compared in blocks."""
    coded = sketched(nodes, tables, table_bits(n, leaf), seed)
    rows = coded.select("node", F.col("s")[0].alias("s1"), F.col("s")[1].alias("s2"), F.posexplode("codes").alias("tab", "code"))
    keys = ["tab", "code"]
    crowded = settled(rows.groupBy(*keys).count().where(F.col("count") > BUCKET))
    return _nearest_in_groups(_in_blocks(rows, keys, crowded, BUCKET), [*keys, "i", "j"], k, most)


def neighbour_lists(pairs: DataFrame, k: int) -> DataFrame:
    """a and near, an array of its k nearest (ham, b), nearest first. A node has at most k entries from each group it was in."""
    each = pairs.groupBy("a", "b").agg(F.min("ham").alias("ham"))
    return each.groupBy("a").agg(F.slice(F.sort_array(F.collect_list(F.struct("ham", F.xxhash64("a", "b").alias("tie"), "b"))), 1, k).alias("near"))


def refine(sketches: DataFrame, lists: DataFrame, k: int, most: int, turn: int, only: DataFrame | None = None) -> DataFrame:
    """Lists of size k after one join of each node's neighbours, forward and back, with each other.

    The nodes that list a node are dealt to groups of at most about MEET by hash, which differs from round to round; all
    its own neighbours are in each of the groups. only: nodes (a) whose lists are wanted; other pairs are not kept.
    """
    forward = lists.select(F.col("a").alias("centre"), F.explode("near.b").alias("node")).union(lists.select(F.col("a").alias("centre"), F.col("a").alias("node")))
    back = lists.select(F.explode("near.b").alias("centre"), F.col("a").alias("node"))
    parts = F.ceil(F.coalesce("count", F.lit(1)) / MEET).cast("int")
    crowded = settled(back.groupBy("centre").count().where(F.col("count") > MEET))
    few = crowded.count() <= 10_000
    joined = lambda df: df.join(F.broadcast(crowded) if few else crowded, "centre", "left")
    dealt = joined(back).select("centre", F.pmod(F.xxhash64("node", F.lit(turn)), parts).cast("int").alias("grp"), "node")
    copied = joined(forward).select("centre", F.explode(F.sequence(F.lit(0), parts - 1)).alias("grp"), "node")
    meet = dealt.union(copied).distinct().join(sketches, "node").withColumn("mine", F.lit(0))
    found = _nearest_in_groups(meet, ["centre", "grp"], k, most)
    if only is not None:
        found = found.join(only, "a", "left_semi")
    old = lists.select("a", F.explode("near").alias("x")).select("a", "x.b", "x.ham")
    return neighbour_lists(old.union(found), k)


def descend(sketches: DataFrame, pairs: DataFrame, k: int, most: int, link_bits: int) -> DataFrame:
    """Rounds of refine() until at most a share of STEADY of the lists change; then saturated lists are enlarged, to ENLARGED at most."""
    lists = settled(neighbour_lists(pairs, k))
    total = lambda c: F.struct(F.size(c), F.aggregate(c, F.lit(0), lambda s, x: s + x["ham"]))
    for turn in range(ROUNDS):
        after = settled(refine(sketches, lists, k, most, turn))
        both = after.alias("n").join(lists.alias("o"), "a", "left").agg(F.count(F.lit(1)), F.count_if(F.col("o.near").isNull() | (total("o.near") != total("n.near"))))
        n, changed = both.first()
        lists = after
        if changed <= STEADY * n:
            break
    while k < ENLARGED:
        full = settled(saturated(lists, k, link_bits))
        if not full.limit(1).count():
            break
        k = min(2 * k, ENLARGED)
        lists = settled(refine(sketches, lists, k, most, ROUNDS + k, full))
    return lists


def saturated(lists: DataFrame, k: int, link_bits: int) -> DataFrame:
    """a of the lists that are full of possible links."""
    return lists.where((F.size("near") >= k) & (F.element_at("near", -1)["ham"] <= link_bits)).select("a")


def checked(pairs: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose vectors have a cosine of at least the threshold."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, t in groups(iter([b]), ["dim"]):
                cosine = np.einsum("ij,ij->i", units(t["va"]), units(t["vb"]))
                t = t.filter(pa.array(cosine >= threshold))
                yield pa.RecordBatch.from_arrays([t["a"].combine_chunks(), t["b"].combine_chunks()], names=["a", "b"])

    side = lambda x: vectors.select(F.col("node").alias(x), F.col("vec").alias(f"v{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(F.size("va") == F.size("vb"))
    return both.select("a", "b", "va", "vb", F.size("va").alias("dim")).mapInArrow(part, "a long, b long")


def dense_counts(members: DataFrame, threshold: float) -> DataFrame:
    """node and links (weights of the others within the threshold) for members(node, vec, weight, component, s1, s2).

    A component's members are sorted into blocks of about BLOCK by the leading bits of their sketches, so that members of a block
    are near each other. Two blocks whose centres and radii put all their pairs within the threshold's angle give
    their members the other block's weight; blocks that are too far apart give nothing; all others are compared.
    """
    angle = acos(threshold)
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    bits = F.least(F.lit(62), F.greatest(F.lit(0), F.ceil(F.log2(F.col("m") / BLOCK)))).cast("int")
    # equal leading bits can still be many: a hash deals such a block to parts of about BLOCK
    dealt = members.join(sizes, "component").withColumn("lead", F.when(bits > 0, F.call_function("shiftrightunsigned", F.col("s1"), F.lit(64) - bits)).otherwise(F.lit(0).cast("long")))
    crowd = dealt.groupBy("component", "lead").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    block = F.xxhash64("lead", F.pmod(F.xxhash64("node"), F.col("parts")))
    dealt = settled(dealt.join(crowd, ["component", "lead"]).select("component", block.alias("block"), F.size("vec").alias("dim"), "node", "vec", "weight"))
    keys = ["component", "block", "dim"]

    def centres(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, t in groups(batches, keys):
            x = units(t["vec"])
            c = x.mean(axis=0)
            c /= np.linalg.norm(c) or 1.0
            radius = float(np.arccos(np.clip(x @ c, -1, 1)).max())
            yield pa.RecordBatch.from_arrays([*[pa.array([k], pa.int64()) for k in key], pa.array([c], pa.list_(pa.float64())), pa.array([radius]), pa.array([t["weight"].to_numpy().sum()], pa.int64())], names=[*keys, "c", "radius", "sum"])

    blocks = dealt.select(*[F.col(k).cast("long").alias(k) for k in keys], "vec", "weight").repartition(*keys).sortWithinPartitions(*keys)
    blocks = settled(blocks.mapInArrow(centres, "component long, block long, dim long, c array<double>, radius double, sum long"))
    x, y = blocks.alias("x"), blocks.alias("y")
    met = x.join(y, (F.col("x.component") == F.col("y.component")) & (F.col("x.dim") == F.col("y.dim")) & (F.col("x.block") <= F.col("y.block")))
    cosine = F.aggregate(F.zip_with("x.c", "y.c", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    between = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
    between = F.when(F.col("x.block") == F.col("y.block"), 0.0).otherwise(between)
    spread = F.col("x.radius") + F.col("y.radius")
    kind = F.when(between + spread <= angle - 1e-6, "all").when(between - spread > angle + 1e-6, "none").otherwise("some")
    met = settled(met.select("x.component", F.col("x.block").alias("i"), F.col("y.block").alias("j"), "x.dim", F.col("x.sum").alias("si"), F.col("y.sum").alias("sj"), kind.alias("kind")).where("kind <> 'none'"))
    given = met.where("kind = 'all'")
    given = given.select("component", F.col("i").alias("block"), "dim", F.col("sj").alias("w")).union(given.where("i <> j").select("component", F.col("j").alias("block"), "dim", F.col("si").alias("w")))
    given = given.groupBy(*keys).agg(F.sum("w").alias("w"))
    own = met.where("kind = 'all' and i = j").select("component", F.col("i").alias("block"), "dim", F.lit(1).alias("own"))  # a node is in its own block's weight
    whole = dealt.join(given, keys).join(own, keys, "left").select("node", (F.col("w") - F.when(F.col("own") == 1, F.col("weight")).otherwise(0)).alias("links"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j, _), t in groups(batches, ["component", "i", "j", "dim"]):
            x, ids, w, mine = units(t["vec"]), t["node"].to_numpy(), t["weight"].to_numpy(), t["block"].to_numpy()
            left, right = mine == i, mine == j
            near = x[left] @ x[right].T >= threshold
            near &= ids[left][:, None] != ids[right][None, :]
            out = [(ids[left], near @ w[right])]
            if i != j:
                out.append((ids[right], near.T @ w[left]))
            for node, links in out:
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(links.astype(np.int64))], names=["node", "links"])

    some = met.where("kind = 'some'")
    wanted = some.select(*["component", "i", "j", "dim"], F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    pairs = dealt.join(wanted, keys).select("component", "i", "j", F.col("dim").cast("long").alias("dim"), "block", "node", "vec", "weight")
    order = ["component", "i", "j", "dim"]
    counted = pairs.repartition(*order).sortWithinPartitions(*order).mapInArrow(compare, "node long, links long")
    return whole.union(counted).groupBy("node").agg(F.sum("links").alias("links"))


def audit(nodes: DataFrame, found: DataFrame, threshold: float) -> float:
    """Mean share of its links that found(node, links) has of each of SAMPLE nodes with links; the sample is broadcast, all nodes are read once.

    Each node counts alike, so that those of dense components do not outweigh pairs.
    """
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("node", "vec").collect()
    by_dim: dict[int, tuple] = {}
    for dim in {len(r.vec) for r in sample}:
        rows = [r for r in sample if len(r.vec) == dim]
        by_dim[dim] = (np.array([r.node for r in rows]), units(pa.chunked_array([pa.array([r.vec for r in rows], pa.list_(pa.float64()))])))
    shared = nodes.sparkSession.sparkContext.broadcast(by_dim)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for (dim,), t in groups(iter([b]), ["dim"]):
                if dim not in shared.value:
                    continue
                ids, x = shared.value[dim]
                near = (x @ units(t["vec"]).T >= threshold) & (ids[:, None] != t["node"].to_numpy()[None, :])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array((near @ t["weight"].to_numpy()).astype(np.int64))], names=["node", "truth"])

    truth = nodes.select("node", "vec", "weight", F.size("vec").alias("dim")).mapInArrow(part, "node long, truth long").groupBy("node").agg(F.sum("truth").alias("truth"))
    share = F.least(F.coalesce("links", F.lit(0)), "truth") / F.col("truth")
    mean = truth.where("truth > 0").join(found, "node", "left").agg(F.avg(share)).first()[0]
    return 1.0 if mean is None else mean


def near_duplicates(embeddings: DataFrame, threshold: float = 0.9, k: int = K, tables: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of embeddings(vec_id, embedding)."""
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(e, lambda x: x != 0)
    vec = F.when(F.coalesce(~bad & some, F.lit(False)), e)
    df = embeddings.select("vec_id", vec.alias("vec"), F.xxhash64(F.lit(1), vec).alias("h1"), F.xxhash64(F.lit(2), vec).alias("h2"))
    kinds = df.where("vec is not null").groupBy("h1", "h2").agg(F.first("vec").alias("vec"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"))
    nodes = settled(kinds.withColumn("node", F.monotonically_increasing_id()))  # numbers are stable over a checkpoint
    vectors = nodes.select("node", "vec", "weight")
    n, tables = nodes.count(), tables or tables_for(nodes.count(), threshold)
    link_bits, most = most_bits(threshold), most_bits(threshold) + BITS // 32

    pairs = None
    for attempt in range(RETRIES + 1):
        more = settled(bucket_pairs(nodes, n, k, most, attempt, tables))
        pairs = more if pairs is None else pairs.union(more)
        known = settled(pairs.select(F.col("a").alias("node")).distinct())  # who is in a list has one: both see each other in the same group
        active = vectors.join(known, "node", "left_semi")
        sketches = settled(sketched(active, 1, 1, 0).select("node", F.col("s")[0].alias("s1"), F.col("s")[1].alias("s2")))
        lists = descend(sketches, pairs, k, most, link_bits)
        near = lists.select("a", F.explode("near").alias("x")).where(F.col("x.ham") <= link_bits).select(F.least("a", "x.b").alias("a"), F.greatest("a", "x.b").alias("b")).distinct()
        links = settled(checked(near, active, threshold))
        named = settled(components(None, links))
        dense = settled(saturated(lists, ENLARGED, link_bits).select(F.col("a").alias("node")))
        crowds = named.join(named.join(dense, "node", "left_semi").select("component").distinct(), "component", "left_semi")
        counted = dense_counts(crowds.join(active, "node").join(sketches, "node"), threshold) if dense.limit(1).count() else None
        weights = vectors.select(F.col("node").alias("b"), "weight")
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        found = both.join(weights, "b").groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("links"))
        if counted is not None:
            found = found.join(crowds.select("node"), "node", "left_anti").union(counted)
        found = settled(found)
        recall = audit(nodes, found, threshold)
        if recall >= RECALL:
            break
    else:
        raise RuntimeError(f"only {recall:.4f} of the links were found after {RETRIES + 1} attempts with {tables} tables each")

    result = nodes.select("node", "h1", "h2", "least", "weight").join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
    result = settled(result.join(found, "node", "left").select("h1", "h2", "least", "component", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links")))
    least = result.groupBy("component").agg(F.min("least").alias("component_id"))
    result = result.join(least, "component").select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), "component_id", "links")
    rows = df.select("vec_id", "h1", "h2", F.col("vec").isNull().alias("none"))
    out = rows.join(result, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")) & ~F.col("none"), "left")
    component = F.when(F.col("none"), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
