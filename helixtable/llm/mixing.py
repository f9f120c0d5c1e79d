"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

A source's target over its size is the expected number of copies of each of its documents. The whole part is taken for
certain. The fractional parts are rounded by the pivotal method: two documents meet, a random one of them takes over as
much of the other's probability as fits, and one of the two is settled at 0 or 1. Documents of a source meet in groups of
bounded size, in order of their sizes, so that what one loses a document of about its size gains; a group leaves at most
one unsettled residual, and residuals meet again in groups of the next level: a reduction tree of logarithmic depth.

What a source's words are off by then, since documents of a group differ in size, is corrected by changing the last copy of a few
documents, from large to small.

Random numbers are hashes of the seed and the two documents, and groups depend on hashes and counts alone, so reruns agree on any
partitioning.

Defined results: a null text has size 0; null sources form one source, last in order; equal rows are units of their
own; an empty table gives an empty table; a source of size 0 has target 0. mix() keeps the columns that it is asked to
carry; results replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixtable.llm.common import JUMPS, fresh, n_words, settled, stash

GROUP = 64
EPS = 1e-9
#: Candidates of a source, a band of sizes and one way of rounding for the correction of a source's words.
PICKED = 64
TRIES = 32


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """sizes(source, source_size) with target: shares by weight, at most `most` times the size, the excess shared again.

    The fixed point of sharing again is a water level: target = least(most * size, level * weight). Sources are taken in
    the order in which they fill; the level is what is left over the weight that is left, at the first source that does
    not fill. The windows run over one row per source, not over documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    k = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (k % len(weights) + 1).cast("int"))
    df = sizes.withColumn("source_no", k).withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    fills = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before, everything = fills.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    df = df.withColumn("level", level)
    df = df.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "source_no", "level"))).over(everything)["level"])
    return df.withColumn("target", F.least(F.col("cap"), F.coalesce("level", F.lit(0.0)) * F.col("weight"))).select("source", "source_no", "source_size", "target")


def _unit(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) from hashed columns."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11).cast("double") / F.lit(float(2**53))


def _meet(seed: int):
    """One step of the pivotal method over (acc: settled picks, carried index, its probability, its hash) and a unit."""

    def step(acc: Column, x: Column) -> Column:
        total = acc["p"] + x["p"]
        r = _unit(seed, acc["u"], x["u"])
        low = total < 1 - EPS
        # below 1: the winner carries the sum and the loser is dropped; from 1 on: one is picked and the other carries the rest
        carried_stays = F.when(low, r * total < acc["p"]).otherwise(r * (2 - total) >= (1 - x["p"]))
        picked = F.when(low, F.lit(None)).when(carried_stays, x["i"]).otherwise(acc["i"])
        left = F.when(low, total).otherwise(total - 1)
        left = F.when(left < EPS, 0.0).otherwise(left)
        return F.struct(
            F.when(picked.isNull(), acc["picks"]).otherwise(F.concat(acc["picks"], F.array(picked))).alias("picks"),
            F.when(carried_stays, acc["i"]).otherwise(x["i"]).alias("i"),
            left.cast("double").alias("p"),
            F.when(carried_stays, acc["u"]).otherwise(x["u"]).alias("u"),
        )

    return step


def _round_groups(df: DataFrame, keys: list[str], unit: Column, seed: int) -> DataFrame:
    """keys, units (array of unit, ordered), picks (indices of those settled at 1), i and p of the unsettled unit."""
    grouped = df.groupBy(*keys).agg(F.sort_array(F.collect_list(unit)).alias("units"))
    pairs = F.transform("units", lambda x, i: F.struct(x["u"].alias("u"), x["p"].alias("p"), i.alias("i")))
    start = F.struct(F.array().cast("array<int>").alias("picks"), F.lit(-1).alias("i"), F.lit(0.0).alias("p"), F.lit(0).cast("long").alias("u"))
    return grouped.withColumn("a", F.aggregate(pairs, start, _meet(seed))).select(*keys, "units", "a.picks", "a.i", "a.p")


def _row_hash(docs: DataFrame) -> Column:
    """What makes a row: all its columns but maps, which have no hash."""
    return F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind])


def _numbered(rows: DataFrame) -> DataFrame:
    """rows, a settled table, with u (a hash) made another number for each repetition; which repetition gets which does not matter.

    Repetitions are numbered within a partition of the settled table and go on after those of the partitions before,
    so that a row that is repeated very often is numbered by many tasks.
    """
    dealt = rows.withColumn("part", F.spark_partition_id())
    counts = settled(dealt.groupBy("u", "part").agg(F.count(F.lit(1)).alias("n")))
    many = counts.groupBy("u").agg(F.sum("n").alias("all")).where("all > 1").select("u")
    before = F.sum("n").over(Window.partitionBy("u").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = settled(counts.join(many, "u", "left_semi").select("u", "part", F.coalesce(before, F.lit(0)).alias("offset")))
    if not offsets.limit(1).count():
        return rows
    rank = F.row_number().over(Window.partitionBy("u", "part").orderBy(F.lit(0))) - 1 + F.col("offset")
    number = F.when(F.col("offset").isNotNull(), rank).otherwise(0)
    numbered = dealt.join(offsets, ["u", "part"], "left").withColumn("number", number)
    return settled(numbered.withColumn("u", F.when(F.col("number") > 0, F.xxhash64("u", "number")).otherwise(F.col("u"))).select(rows.columns))


def mix(docs: DataFrame, carry: list[str], weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 7) -> DataFrame:
    """The carried columns of docs (narrow ones: they go through the rounding) with size, source_size, target and copies (how often the mix takes the row)."""
    names = [c for c in carry if c not in ("size", "source_size", "target", "copies")]
    rows = settled(docs.select(F.struct(*names).alias("row") if names else F.lit(None).alias("row"), "source", n_words(F.col("text")).alias("size"), _row_hash(docs).alias("u")))
    out = _rounded(_numbered(rows), weights, most, seed)
    return out.select(*(["row.*"] if names else []), "size", "source_size", "target", "copies")


def _rounded(rows: DataFrame, weights: tuple[int, ...], most: int, seed: int) -> DataFrame:
    """row, u, size, source_size, target and copies for rows(row, source, size, u)."""
    band = F.floor(F.log2(F.col("size") + 1.0) * 2).cast("int")
    banded = settled(rows.groupBy("source", band.alias("band")).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")))
    targets = source_targets(banded.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = settled(
        banded.alias("b")
        .join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
        .select("b.source", "band", "source_no", "source_size", "target", F.floor(copies + EPS).cast("int").alias("whole"), copies.alias("f"), F.ceil(F.col("n") / GROUP).alias("groups"))
        .withColumn("p", F.greatest(F.lit(0.0), F.col("f") - F.col("whole")))
        .drop("f")
    )
    key = ["source_no", "band", "salt"]
    units = (
        rows.withColumn("band", band).alias("r")
        .join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.band") == F.col("p.band")))
        .select("row", "size", "u", "source_no", "p.band", "source_size", "target", "whole", "groups", "p.p", F.pmod(F.col("u"), F.col("groups")).cast("int").alias("salt"))
    )
    first = stash(_round_groups(units, [*key, "source_size", "target", "whole", "groups"], F.struct("size", "u", "p", "row"), seed))

    # residuals meet others of their band first, then, with one left for each band, those of twice as wide a band
    rest = first.select(*key, F.xxhash64(*key).alias("u"), F.col("p"), F.element_at("units", F.col("i") + 1)["size"].alias("size"), F.col("band").alias("wide")).where(F.col("p") > EPS)
    rest, done, level = settled(rest), [], 0
    while True:
        counts = rest.groupBy("source_no", "wide").count()
        bands, widest = counts.groupBy("source_no").agg(F.count(F.lit(1)).alias("n"), F.max("count").alias("m")).agg(F.max("n"), F.max("m")).first()
        if (bands or 0) <= 1 and (widest or 0) <= 1:
            break
        level += 1
        if widest <= 1:
            rest = rest.withColumn("wide", F.shiftright("wide", 1))
            counts = rest.groupBy("source_no", "wide").count()
        # one column as the key: rows that the join has dealt by source would else stay together by source
        group = F.xxhash64("source_no", "wide") + F.pmod(F.xxhash64(F.lit(level), "u"), F.ceil(F.col("count") / GROUP))
        salted = rest.join(counts, ["source_no", "wide"]).select(group.alias("g"), F.struct("size", "u", "p", "source_no", "band", "salt", "wide").alias("unit"))
        here = settled(_round_groups(salted, ["g"], F.col("unit"), seed + level))
        out = here.select("picks", "i", "p", F.posexplode("units").alias("at", "x"))
        out = out.select("x.source_no", "x.band", "x.salt", "x.wide", "x.u", "x.size", F.array_contains("picks", F.col("at")).alias("chosen"), (F.col("at") == F.col("i")).alias("open"), F.col("p"))
        done.append(out.where("not open or p <= 1e-9").select(*key, "chosen"))
        rest = settled(out.where("open and p > 1e-9").select(*key, "u", "p", "size", "wide"))
    last = rest.select(*key, (_unit(seed, F.col("u")) < F.col("p")).alias("chosen"))
    for d in done:
        last = last.unionByName(d)
    out = first.join(last, key, "left").select("source_no", "band", "source_size", "target", "whole", "groups", "picks", "i", "p", "chosen", F.posexplode("units").alias("at", "x"))
    one_more = F.array_contains("picks", F.col("at")) | ((F.col("at") == F.col("i")) & F.coalesce("chosen", F.lit(False)))
    rounded = stash(out.select("source_no", "band", "x.row", "x.u", "x.size", "source_size", "target", "whole", "groups", (F.col("x.p") > EPS).alias("open"), one_more.alias("more")))
    flips = _corrections(rounded).withColumn("flip", F.lit(True))
    flips = F.broadcast(flips) if flips.count() <= JUMPS else flips
    more = F.col("more") != F.coalesce("flip", F.lit(False))
    return rounded.join(flips, ["source_no", "u"], "left").select("row", "u", "size", "source_size", "target", (F.col("whole") + more.cast("int")).alias("copies"))


def _corrections(rounded: DataFrame) -> DataFrame:
    """source_no and u of documents whose last copy is taken or left the other way, so that their source's words come near its target.

    The tree keeps numbers of documents, so the words of a source are off by what documents of one group differ in size, and by the few
    that were settled among bands: little beside many documents, much beside few. Of each source and band some documents, picked by their
    hash, are candidates; from the largest to the smallest, the one whose change brings the sum nearer is changed. The best
    counts of such runs without and with a change of one of the TRIES largest candidates that comes first whatever it does. A source's candidates are at most 2 * PICKED for each band of sizes, in one row.
    """
    words = F.sum(F.col("size") * (F.col("whole") + F.col("more").cast("int")))
    off = rounded.groupBy("source_no").agg((words - F.first("target")).alias("off"))
    # about 16 * PICKED of a band at most get to the ranks: a group of the tree has GROUP documents or so
    luck = _unit(11, F.col("u")) * F.col("groups") * GROUP < 16.0 * PICKED
    near = rounded.where("open and size > 0").where(luck).select("source_no", "band", "more", "u", "size")
    rank = F.row_number().over(Window.partitionBy("source_no", "band", "more").orderBy(F.xxhash64(F.lit(12), F.col("u")), "u"))
    some = near.withColumn("rank", rank).where(F.col("rank") <= PICKED)
    lists = some.groupBy("source_no").agg(F.sort_array(F.collect_list(F.struct("size", "u", "more")), False).alias("units")).join(off, "source_no")

    change = lambda x: F.when(x["more"], -x["size"]).otherwise(x["size"])

    def run(first: Column) -> Column:
        """Words off and changes, where the candidate of that number is changed whatever it does; with 0, none is."""
        forced = F.get("units", first - 1)

        def step(a: Column, x: Column) -> Column:
            then = a["off"] + change(x)
            nearer = (F.abs(then) < F.abs(a["off"])) & ~x["u"].eqNullSafe(forced["u"])
            return F.struct(F.when(nearer, then).otherwise(a["off"]).alias("off"), F.when(nearer, F.concat(a["flips"], F.array(x["u"]))).otherwise(a["flips"]).alias("flips"))

        off = F.col("off").cast("double") + F.coalesce(change(forced), F.lit(0))
        flips = F.when(forced.isNull(), F.array().cast("array<bigint>")).otherwise(F.array(forced["u"]))
        return F.aggregate("units", F.struct(off.alias("off"), flips.alias("flips")), step)

    tries = F.transform(F.sequence(F.lit(0), F.least(F.lit(TRIES), F.size("units"))), run)
    best = F.array_min(F.transform(tries, lambda t: F.struct(F.abs(t["off"]).alias("off"), t["flips"].alias("flips"))))
    return settled(lists.select("source_no", F.explode(best["flips"]).alias("u")))


def take(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 7) -> DataFrame:
    """The mixed corpus: rows of docs, each as often as the mix takes it, with the columns of docs.

    Only hashes of rows and their sizes are rounded; texts move once, to the numbers of copies. A row that is repeated in
    full gets the sum of its repetitions' copies, dealt to them as evenly as can be.
    """
    own, times = fresh(docs, "mix_row"), fresh(docs, "mix_copies")
    h = _row_hash(docs)
    rows = settled(docs.select(F.lit(None).alias("row"), "source", n_words(F.col("text")).alias("size"), h.alias("u"), h.alias("h")).withColumn("row", F.struct("h")).drop("h"))
    numbered = _numbered(rows)
    plan = settled(_rounded(numbered, weights, most, seed).groupBy("row.h").agg(F.sum("copies").alias("total"), F.count(F.lit(1)).alias("n")))
    even = plan.where("total % n = 0 and total > 0").select(F.col("h").alias(own), (F.col("total") / F.col("n")).cast("int").alias(times))
    out = docs.withColumn(own, h).join(even, own).select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(times))).alias(times)).select(docs.columns)
    uneven = plan.where("total % n <> 0")
    if uneven.limit(1).count():
        # one row stands for all its repetitions here: they are alike in every column
        one = docs.withColumn(own, h).join(uneven.select(F.col("h").alias(own), F.col("total").cast("int").alias(times)), own).dropDuplicates([own])
        out = out.unionByName(one.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(times))).alias(times)).select(docs.columns))
    return out
