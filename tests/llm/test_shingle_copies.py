"""Near copies by word shingles against brute-force Jaccard pairs."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from helixtable.llm import near_copies, simhash
from tests.llm.conftest import words
from tests.llm.test_near_copies import groups


def shingle_set(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])


def wanted(rows):
    """Representatives (doc_id, text) of the groups that all pairs of Jaccard similarity 0.8 or more make."""
    sets = list({shingle_set(r.text) for r in rows})
    linked = [(a, b) for i, a in enumerate(sets) for b in sets[:i] if a and b and len(a & b) / len(a | b) >= 0.8]
    return [min((r.doc_id is None, r.doc_id or 0) for r in rows if shingle_set(r.text) in g) for g in groups(sets, linked)]


def edited(spark):
    """Copies with some words changed, a large group that shares its keys, and a line that most documents have."""
    rng = random.Random(3)
    new = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    line, rows = "this common line stands in nearly all of the documents here".split(), []
    for _ in range(60):
        base = new(rng.randrange(30, 200)) + line
        rows.append(base)
        for _ in range(3):
            copy = list(base)
            for _ in range(rng.randrange(1, 6)):
                copy[rng.randrange(len(copy))] = new(1)[0]
            rows.append(copy)
    base = new(150)
    for _ in range(120):
        copy = list(base)
        for _ in range(rng.randrange(1, 7)):
            copy[rng.randrange(len(copy))] = new(1)[0]
        rows.append(copy)
    rows += [rows[0], [w.upper() for w in rows[1]], new(4), new(3), [], []]
    rng.shuffle(rows)
    return spark.createDataFrame([(i if i % 50 else None, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("which", ["odd", "docs", "edited"])
def test_near_copies_against_brute_force(which, request, spark):
    df = edited(spark) if which == "edited" else request.getfixturevalue(which)
    got = corpus_pipeline.near_copies(spark, df, "")
    assert got.columns == df.columns
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == Counter(wanted(df.collect()))


def test_order_of_shingles_changes_nothing(spark, monkeypatch):
    df = edited(spark)
    monkeypatch.setattr(near_copies, "COMMON", 1)
    monkeypatch.setattr(near_copies, "REPS", 1)
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in near_copies.keep_one(df).collect()) == Counter(wanted(df.collect()))


def test_empty(spark):
    assert near_copies.keep_one(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_closest_fingerprints_against_brute_force(spark):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) - 2**63 for _ in range(300)}
    fps |= {f ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(1, 8))) for f in fps}
    bits = lambda a, b: ((a ^ b) % 2**64).bit_count()
    got = {}
    for r in simhash.closest(spark.createDataFrame([(f,) for f in fps], "fp long")).collect():
        got.setdefault(r.a, []).append(bits(r.a, r.b))
    nearest = {f: min(bits(f, g) for g in fps if g != f) for f in fps}
    assert {f: min(n) for f, n in got.items()} == {f: n for f, n in nearest.items() if n <= simhash.WIDE}
    assert all(n <= simhash.WIDE for ns in got.values() for n in ns)


def test_crowded_keys_bring_few_links(spark):
    fps = [(7 << 43 | i << 10,) for i in range(1500)]
    assert spark.createDataFrame(fps, "fp long").transform(simhash.closest).count() <= 2 * len(fps)


def test_simhash_links_come_first(spark, monkeypatch):
    """Copies with close fingerprints are one group by SimHash, and their keys are not paired again."""
    base = [f"u{i}" for i in range(2000)]
    copies = [base, [*base[:-1], "other"], [*base[:-2], "two", "more"]]
    df = spark.createDataFrame([(i, " ".join(c)) for i, c in enumerate(copies)], "doc_id long, text string")
    asked, whole = [], near_copies._verified

    def spy(pairs, texts, similarity):
        asked.append(pairs.count())
        return whole(pairs, texts, similarity)

    monkeypatch.setattr(near_copies, "_verified", spy)
    assert [r.doc_id for r in corpus_pipeline.near_copies(spark, df, "").collect()] == [0]
    assert asked[0] >= 2 and asked[1:] == [0, 0]
