"""Quality rules, sharding and mixing against brute force."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helixtable.llm import mixing, quality_rules, sharding
from tests.llm.conftest import words


def features(text):
    w = words(text)
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i : i + 3])].append(i)
    covered = {i + k for p in at.values() if len(p) > 1 for i in p for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_features(which, request):
    df = request.getfixturevalue(which)
    got = quality_rules.cascade(df).select("text", *quality_rules.FEATURES, "base_failed", "kept").collect()
    assert len(got) == df.count()
    for r in got:
        assert tuple(r[1:7]) == features(r.text), r.text and r.text[:80]
        assert not (r.base_failed and r.kept)


def test_verdict_does_not_depend_on_order(docs):
    rules = quality_rules.default_rules()
    one = quality_rules.cascade(docs, rules, ordered=True).where("kept").select("doc_id")
    other = quality_rules.cascade(docs, rules[::-1], ordered=True).where("kept").select("doc_id")
    assert sorted(one.collect()) == sorted(other.collect())
    assert 0 < one.count() < docs.count()
    assert sorted(r.doc_id for r in quality_rules.keep_good(docs).collect()) == sorted(r.doc_id for r in one.collect())


def verdict(text):
    """default_rules() and the base rule, rule by rule."""
    import re

    n, chars, symbols, dups, _, failed = features(text)
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    capitals = [x for x in w if re.search(r"[^\W\d_]{2}", x) and x.upper() == x and any(a.isupper() and b.isupper() for a, b in zip(x, x[1:]))]
    rejects = [symbols * 10 > n, dups * 10 > len(lines) * 3, chars < 3 * n or chars > 10 * n, sum(any(c.isalpha() for c in x) for x in w) * 10 < n * 8, len(capitals) * 10 > n * 3, len(re.findall("[!?]{2,}", text or "")) * 10 > n]
    return not (failed or any(rejects))


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_verdicts_against_brute_force(which, request):
    df = request.getfixturevalue(which)
    rows = quality_rules.cascade(df).select("text", "kept").collect()
    assert all(r.kept == verdict(r.text) for r in rows)
    assert sum(r.kept for r in rows) == quality_rules.keep_good(df).count()


def test_order_follows_cost_and_rejections(docs):
    """A costly rule goes behind a cheap one that rejects as much, and a rule that rejects more goes before one of the same cost."""
    slow = F.sha2(F.repeat(F.sha2("text", 256), 4000), 512) > "0"
    cheap, costly = quality_rules.Rule("cheap", F.octet_length("text") % 2 == 0), quality_rules.Rule("costly", slow & (F.octet_length("text") % 2 == 0))
    none = quality_rules.Rule("none", F.octet_length("text") < 0)
    ordered = [r.name for r in quality_rules.order_rules(docs, [costly, none, cheap])]
    assert ordered.index("cheap") < ordered.index("costly")
    estimates, _ = quality_rules.estimate_rules(quality_rules.sample_of(docs), [costly, none, cheap])
    assert estimates[0].seconds > 3 * estimates[2].seconds and estimates[1].rejects == 0 < estimates[2].rejects


def test_rules_keep_clean_and_reject_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    rows = quality_rules.cascade(docs).where("n_words >= 50").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()
    share = {r.quality: r.share for r in rows}
    assert share[1] >= 0.99 and share[0] <= 0.1


def test_empty_tables(spark, odd):
    none = odd.where("false")
    assert quality_rules.cascade(none).count() == sharding.assign(none).count() == mixing.mix(none, ["doc_id"]).count() == 0


def best_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        used, room = 1, mid
        for s in sizes:
            if s > room:
                used, room = used + 1, mid
            room -= s
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


@pytest.mark.parametrize("which,shards", [("odd", 24), ("odd", 2), ("docs", 24), ("docs", 5)])
def test_sharding(which, shards, request):
    df = request.getfixturevalue(which)
    got = sharding.assign(df, shards).collect()
    assert len(got) == df.count()
    by, groups = defaultdict(list), defaultdict(set)
    for r in got:
        by[r.shard].append(r.slot)
        groups[(r.text_crc32, r.size)].add(r.shard)
    assert all(sorted(v) == list(range(len(v))) and 0 <= k < shards for k, v in by.items())
    assert all(len(v) == 1 for v in groups.values())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in df.collect())
    order = df.groupBy(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 8).alias("b")).orderBy("h")
    load = Counter()
    for r in got:
        load[r.shard] += r.size
    assert max(load.values()) == best_capacity([r.b for r in order.collect()], shards)


def test_shards_beside_an_oversized_group(spark):
    """A text with a third of the bytes has a shard of its own; the others are near equal and none is empty."""
    df = spark.range(6000).selectExpr("id as doc_id", "if(id < 2000, 'hot hot hot', concat('t', lpad(cast(id as string), 10, '0'))) as text").repartition(4)
    load = Counter()
    for r in sharding.assign(df, 24).collect():
        load[r.shard] += r.size
    others = sorted(load.values())[:-1]
    assert len(load) == 24 and max(load.values()) == 2000 * 19 and max(others) <= 1.2 * min(others)


def test_sharding_refines_ranges(spark):
    groups = spark.range(30_000).select(F.xxhash64("id").alias("h"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) + F.when(F.col("id") == 5, 900_000).otherwise(1)).alias("bytes"))
    capacity, cuts = sharding.minimax_cuts(groups, 24)
    sizes = [r.bytes for r in groups.orderBy("h").collect()]
    assert capacity == best_capacity(sizes, 24) and len(cuts) <= 24


def water(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        full = [s for s in free if level * w[s] > most * sizes[s]]
        if not full:
            return out | {s: level * w[s] for s in free}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def nearest(rows, target):
    """The least gap that any choice of one more or less of each document's copies leaves."""
    sums = {0}
    for r in rows:
        f = r.target / r.source_size if r.source_size else 0
        low, high = math.floor(f + 1e-9), math.ceil(f - 1e-9)
        sums = {x + k * r.size for x in sums for k in {low, high}}
    return min(abs(x - target) for x in sums)


@pytest.mark.parametrize("which", ["odd", "docs", "more", "many"])
def test_mixing(which, request, spark):
    if which == "more":
        df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    elif which == "many":
        df = spark.range(20_000).selectExpr("id as doc_id", "repeat('w ', cast(1 + pmod(xxhash64(id), 90) as int)) as text", "if(id % 3 = 0, 'hot', if(id % 7 = 0, null, concat('s', id % 5))) as source")
    else:
        df = request.getfixturevalue(which)
    got = mixing.mix(df, ["doc_id", "source"])
    again = mixing.mix(df.repartition(7), ["doc_id", "source"])
    rows = got.collect()
    assert Counter(rows) == Counter(again.collect()) and len(rows) == df.count()
    sizes = Counter()
    for r in df.collect():
        sizes[r.source] += len(words(r.text))
    expected, taken = water(sizes), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source])
        f = r.target / r.source_size if r.source_size else 0
        assert f - 1 < r.copies < f + 1 and 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    # sources have some five documents or ten; fifty; thousands
    share = {"odd": 0.03, "docs": 0.03, "more": 0.01, "many": 0.001}[which]
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= share * expected[s] + (nearest([r for r in rows if r.source == s], expected[s]) if which != "many" else 0)
    assert mixing.take(df, seed=7).count() == sum(r.copies for r in rows)


def test_mixing_of_a_row_repeated_very_often(spark):
    """Repetitions are units of their own, also where they are most rows; take() gives the same copies."""
    df = spark.range(3000).selectExpr("if(id < 2000, 1, id) as doc_id", "'a b c' as text", "if(id < 2000 or id % 2 = 0, 'hot', 'b') as source").repartition(6)
    rows = mixing.mix(df, ["doc_id", "source"]).collect()
    again = mixing.mix(df.repartition(3), ["doc_id", "source"]).collect()
    assert Counter(rows) == Counter(again) and len(rows) == 3000
    for s, t in water({"hot": 7500, "b": 1500}).items():
        assert abs(sum(r.copies * r.size for r in rows if r.source == s) - t) <= 6
    taken = Counter(r.doc_id for r in mixing.take(df).collect())
    want = Counter()
    for r in rows:
        want[r.doc_id] += r.copies
    assert taken == +want


def test_mixing_rounds_without_bias(spark):
    df = spark.range(300).selectExpr("id as doc_id", "'a b c d' as text", "if(id < 200, 'a', 'b') as source")
    picks = Counter()
    for seed in range(4):
        for r in mixing.mix(df, ["doc_id"], seed=seed).collect():
            picks[r.doc_id < 200] += r.copies
    assert picks[True] / 4 == pytest.approx(300 * 5 / 7, abs=1.1) and picks[False] / 4 == pytest.approx(300 * 2 / 7, abs=1.1)
