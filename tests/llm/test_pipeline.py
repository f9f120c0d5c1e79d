"""The pipeline's stages, each against brute force on its own input."""

from collections import Counter
from types import SimpleNamespace

import pytest

import corpus_pipeline
from tests.llm.conftest import words
from tests.llm.test_native import features, nearest, water
from tests.llm.test_near_copies import stripped
from tests.llm.test_shingle_copies import wanted
from tests.llm.test_tokens import check, encode  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        out.append((docs.collect(), after.collect()))
        docs = spark.createDataFrame(out[-1][1], docs.schema) if stage is not corpus_pipeline.STAGES[-1][1] else None
    return out


def test_columns(spark, steps):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert all(set(after[0].asDict()) == set(docs.columns) for _, after in steps[:-1])


def test_quality(steps):
    before, after = steps[0]
    kept = {r.doc_id for r in after}
    assert 0 < len(after) < len(before)
    assert not any(features(r.text)[-1] for r in after)
    clean = [r for r in before if not features(r.text)[-1] and features(r.text)[2] == 0 and "!!" not in r.text]
    assert all(r.doc_id in kept for r in clean if features(r.text)[3] == 0)


def test_near_copies(steps):
    before, after = steps[1]
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in after) == Counter(wanted(before))


def test_passages(steps):
    before, after = steps[2]
    want = {i: (kept if gone else r.text) for (i, _, gone, kept), r in zip(stripped(before), before)}
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)


def test_mix(steps):
    before, after = steps[3]
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r.source] += len(words(r.text))
    for r in after:
        taken[r.source] += len(words(r.text))
    assert max(Counter(r.doc_id for r in after).values()) <= 3
    for s, t in water(sizes).items():
        rows = [SimpleNamespace(target=t, source_size=sizes[s], size=len(words(r.text))) for r in before if r.source == s]
        assert abs(taken[s] - t) <= 0.05 * t + nearest(rows, t)  # some five documents a source


def test_pack(steps, encode):  # noqa: F811
    before, after = steps[4]
    assert check(after, before, encode) <= -(-sum(r.length for r in after) // 1024) + 2


def test_run(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in got.collect()) == Counter((r.doc_id, r.piece, r.ids_crc32) for r in steps[-1][1])
