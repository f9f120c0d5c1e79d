"""Blocked products against scores term by term."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helixtable.llm import lexical_search
from tests.llm.conftest import SF
from tests.llm.test_edges import CLASHING


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(rows, items, top=50):
    docs = [(r.doc_id, Counter(terms(r.text))) for r in rows if terms(r.text)]
    n_docs, total, df = len(docs), sum(c.total() for _, c in docs), Counter(t for _, c in docs for t in c)
    wanted, out = defaultdict(set), {}
    for r in items:
        wanted[r.item_id] |= set(terms(r.text))
    for item, ts in wanted.items():
        found = []
        for i, c in docs:
            m = 50 + 50 * c.total() * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if score > 0:
                found.append((-score, i is None, i))
        for rank, (s, _, i) in enumerate(sorted(found)[:top], 1):
            out[item, rank] = (i, -s)
    return out


def compare(docs, items, **how):
    got = lexical_search.search(docs, items, **how)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = expected(docs.collect(), items.collect(), **how)
    assert {(r.item_id, r["rank"]): (r.doc_id, r.score) for r in got.collect()} == want and got.count() == len(want)
    return want


def test_search(spark, docs):
    assert compare(docs.repartition(5), spark.read.parquet(f"{SF}/benchmark.parquet"))


def test_odd_rows_ties_and_rounds(spark, odd, monkeypatch):
    copies = spark.range(300).selectExpr("id + 100 as doc_id", "'One two TWO, three' as text", "'s' as source", "1 as shard")
    df = odd.union(copies).select("*", *[F.lit(f"mine {c}").alias(c) for c in [*CLASHING, "term", "terms", "tf", "rank", "score"]])
    texts = [("a", "one two"), ("b", "LINE, one-here \u6f22\u5b57"), ("c", None), ("d", " .,; "), (None, "w1 w2 w3"), ("b", "other"), ("e", "nowhere met"), ("f", "A b C x")]
    items = spark.createDataFrame(texts, "item_id string, text string").withColumn("round", F.lit("mine"))
    assert {k[0] for k in compare(df, items)} == {"a", "b", None, "f"}
    monkeypatch.setattr(lexical_search, "POSTINGS", 2)
    compare(df, items, top=3)
    assert lexical_search.search(df.where("false"), items).count() == 0 and lexical_search.search(df, items.where("false")).count() == 0


def test_string_identifiers_and_very_long_texts(spark):
    texts = {"d1": "w " * 2_000_000, "d2": "x" * 3_000_000, "d3": " ".join(f"w{i}" for i in range(300_000)), "d4": "w w7 w299999"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string").repartition(2)
    compare(docs, spark.createDataFrame([(1, "w w7 w299999 " + "x" * 3_000_000)], "item_id int, text string"))


@pytest.mark.parametrize("columns", [3, 4096])
def test_products_stay_exact(columns, monkeypatch):
    """Weights so large that a tile's sum would pass 2**53 with few columns already."""
    monkeypatch.setattr(lexical_search, "COLUMNS", columns)
    rng = np.random.default_rng(1)
    owner, cols = np.divmod(rng.choice(5 * 40, 90, replace=False), 40)
    doc, term = np.divmod(rng.choice(7 * 60, 200, replace=False), 60)
    weights, impact = rng.integers(0, 3_000_000_000, 60), rng.integers(0, lexical_search.IMPACT, 200)
    w, x = np.zeros((5, 60), dtype=object), np.zeros((60, 7), dtype=object)
    w[owner, cols], x[term, doc] = weights[cols], impact
    assert (lexical_search._products(owner, cols, weights, 5, doc, term, impact, 7) == w @ x).all()


def test_best_of_many_tiles(monkeypatch):
    monkeypatch.setattr(lexical_search, "HELD", 40)
    rng = np.random.default_rng(2)
    best, seen = lexical_search._Best(6, pa.int64(), 5), []
    for tile in range(30):
        ids, scores = np.sort(rng.choice(10_000, 20, replace=False)), rng.integers(0, 4, (3, 20))
        first = tile % 2 * 3
        best.add(scores, first, pa.array(ids))
        seen += [(first + i, -s, d) for i, row in enumerate(scores.tolist()) for s, d in zip(row, ids.tolist()) if s > 0]
    want = [x for i in range(6) for x in sorted(s for s in seen if s[0] == i)[:5]]
    assert [(r["item"], -r["score"], r["id"]) for r in best.compare().to_pylist()] == want
