"""Packed counters against applying the filters one by one, in every order."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from helixtable.llm import filter_audit
from tests.llm.conftest import SF, words
from tests.llm.test_edges import CLASHING


def expected(rows, labels):
    least = defaultdict(list)
    for r in rows:
        if r.doc_id is not None:
            least[r.text or ""].append(r.doc_id)
    good, toxic = {r.doc_id for r in labels if r.quality == 1}, {r.doc_id for r in labels if r.toxic == 1}
    out = defaultdict(Counter)
    for r in rows:
        t = r.text or ""
        w = words(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t))}
        fails["E"] = r.doc_id is not None and r.doc_id > min(least[t])
        for p in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(p, 1):
                c = out[r.lang or "", "".join(p), step]
                c["kept"] += not gone and not fails[f]
                c["redundant"] += gone and fails[f]
                c["unique_fails"] += fails[f] and sum(fails.values()) == 1
                if fails[f] and not gone:
                    gone = True
                    c["removed"] += 1
                    c["good_lost"] += r.doc_id in good and r.doc_id is not None
                    c["toxic_lost"] += r.doc_id in toxic and r.doc_id is not None
    shapley = Counter()
    for (part, p, step), c in out.items():
        shapley[part, p[step - 1]] += c["removed"]
    for (part, p, step), c in out.items():
        c["shapley"] = shapley[part, p[step - 1]]
    return out


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_audit(which, request, spark):
    df = request.getfixturevalue(which)
    if which == "docs":
        labels = spark.read.parquet(f"{SF}/labels.parquet")
    else:
        marks = [F.lit(f"mine {c}").alias(c) for c in [*CLASHING, "digest", "mask", "first", "good"]]
        df = df.select("*", F.when(F.col("doc_id") > 5, F.col("source")).alias("lang"), *marks)
        labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (6, 1, 1), (None, 1, 1), (9, None, 1), (10, 1, None)], "doc_id long, quality int, toxic int").withColumn("part", F.lit("mine"))
    got, want = filter_audit.filter_audit(df, labels).collect(), expected(df.collect(), labels.collect())
    assert len(got) == len(want) == 600 * len({k[0] for k in want})
    for r in got:
        c = want[r.part, r.filter_order, r.step]
        assert {k: v for k, v in r.asDict().items() if k not in ("part", "filter_order", "step")} == {k: c[k] for k in [*filter_audit.COUNTERS, "shapley"]}
    assert filter_audit.filter_audit(df.where("false"), labels).count() == 0


def test_sums_of_very_many_rows_and_parts(spark):
    """Counts beyond 32 bits stay in their fields; tasks give their sums on where parts are many."""
    df = spark.range(3000).selectExpr("concat('p', id % 1500) as part", "cast(id % 128 as int) as mask", "36028797018963968 + id as n")
    got = {(r.part, r.filter_order, r.step): r for r in filter_audit.audit(df).where("filter_order in ('ABCDE', 'EDCBA') and step = 5").collect()}
    assert len(got) == 3000
    for i in range(1500):
        rows = [(k % 128, 2**55 + k) for k in (i, i + 1500)]
        assert got[f"p{i}", "ABCDE", 5].kept == sum(n for m, n in rows if m & 31 == 0)
        assert got[f"p{i}", "ABCDE", 5].removed == sum(n for m, n in rows if m & 31 == 16)
        assert got[f"p{i}", "EDCBA", 5].redundant == sum(n for m, n in rows if m & 1 and m & 30)
        # a filter is the first of a row's failed ones in an even share of the orders
        assert got[f"p{i}", "EDCBA", 5].shapley == sum(120 * n // (m & 31).bit_count() for m, n in rows if m & 1)


def test_very_long_texts():
    text = " ".join(f"w{i % 1000}" for i in range(500_000))
    assert filter_audit.failures(text) == 2
    assert filter_audit.failures("x" * 3_000_000) == 1
    assert filter_audit.failures("") == 1
    text = " ".join(f"w{i}" for i in range(400_000))
    assert filter_audit._n_words(text.encode()) == (400_000, 400_000)
