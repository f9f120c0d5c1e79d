"""Chunk recipes against grouping by normalised texts."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helixtable.llm import exact_dedup
from tests.llm.test_edges import CLASHING


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    """doc_id, keep_id, group_size and sha of each row, and how many rows of each (doc_id, text) stay."""
    groups = defaultdict(list)
    for r in rows:
        groups[normal(r.text)].append(r.doc_id)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    out = Counter((r.doc_id, least[normal(r.text)], len(groups[normal(r.text)]), hashlib.sha256(normal(r.text).encode()).hexdigest()) for r in rows)
    return out, Counter((least[t], hashlib.sha256(t.encode()).hexdigest()) for t in groups)


def compare(df, **how):
    got, (want, stay) = exact_dedup.exact_groups(df, **how).collect(), expected(df.collect())
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert Counter((r.doc_id, r.text_sha256) for r in got if r.kept) == stay


@pytest.mark.parametrize("which", ["odd", "docs", "spaces"])
def test_groups(which, request, spark):
    if which == "spaces":
        texts = ["a b", "a  b", "a\n\tb", " a b", "a b ", "\ta b\n", "", None, " ", "\n\n", "a b", "a b"] * 2
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    else:
        df = request.getfixturevalue(which)
    compare(df)


def test_hot_groups_long_texts_and_string_identifiers(spark, monkeypatch):
    rng = random.Random(1)
    long = "".join(rng.choices("abcdef \n", k=300_000))
    texts = [f"own text {i}" for i in range(300)] + ["a common text"] * 200 + ["pair", "pair "[:4]] + [long, long.replace("\n", " "), long[:-1], "x" + long] + ["y" * 200_000] * 3
    df = spark.createDataFrame([(f"d-{i}", t) for i, t in enumerate(texts)], "doc_id string, text string").repartition(5)
    compare(df)
    monkeypatch.setattr(exact_dedup, "HOT", 10)
    monkeypatch.setattr(exact_dedup, "SHORT", 8)
    compare(df)


def test_identifiers_that_clash_are_taken_anew(spark, docs):
    """With four bits nearly all chunks share their identifiers; the comparison of bytes finds that, and recipes get longer ones."""
    few = exact_dedup._recipes(docs, "doc_id", "text", 4, 0)
    assert not exact_dedup._verified(docs, "text", few, 4, 0)
    compare(docs, bits=4)


def test_chunks_depend_on_content_alone():
    rng = random.Random(2)
    data = rng.randbytes(3_000_000)
    cut = list(exact_dedup.chunks(data))
    assert b"".join(cut) == data and all(len(c) <= exact_dedup.MOST for c in cut) and all(len(c) >= exact_dedup.LEAST for c in cut[:-1])
    assert exact_dedup.USUAL / 2 < len(data) / len(cut) < exact_dedup.USUAL * 2
    moved = list(exact_dedup.chunks(b"some new beginning" + data))
    assert len(set(cut) & set(moved)) > 0.95 * len(cut)
    assert [len(c) for c in exact_dedup.chunks(b"z" * 100_000)] == [exact_dedup.MOST] * 3 + [100_000 - 3 * exact_dedup.MOST]
    assert list(exact_dedup.chunks(b"")) == []


def test_rows_that_stay(spark, odd):
    df = odd.select("*", *[F.lit(f"mine {c}").alias(c) for c in [*CLASHING, "hi", "lo", "sha", "keep_id", "kept_id", "kept_sha"]])
    kept = exact_dedup.keep_one(df)
    assert kept.columns == df.columns
    assert Counter(normal(r.text) for r in kept.collect()) == Counter({normal(r.text): 1 for r in df.collect()})
    assert exact_dedup.exact_groups(df.where("false")).count() == 0 and exact_dedup.keep_one(df.where("false")).count() == 0
