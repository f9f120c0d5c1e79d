"""SimHash groups and repeated windows against brute force."""

import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from helixtable.llm import simhash, substring
from helixtable.llm.common import components
from tests.llm.conftest import words


def fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    n = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for i in range(64):
            n[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * n[i] > len(grams))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        root[find(a)] = find(b)
    out = defaultdict(set)
    for n in nodes:
        out[find(n)].add(n)
    return out.values()


def pairs(fps, bits=2):
    fps = sorted(fps)
    return [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= bits]


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_simhash(which, request):
    df = request.getfixturevalue(which)
    rows = df.collect()
    fp = [fingerprint(r.text) for r in rows]
    comp = {}
    for g in groups(set(fp), pairs(set(fp))):
        ids = [r.doc_id for r, f in zip(rows, fp) if f in g and r.doc_id is not None]
        comp |= {f: min(ids, default=None) for f in g}
    got = simhash.clusters(df, ["doc_id"]).collect()
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == Counter((r.doc_id, f, comp[f]) for r, f in zip(rows, fp))
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert Counter(fp[[x.text for x in rows].index(r.text)] in g for r in kept.collect() for g in groups(set(fp), pairs(set(fp))))[True] == len(list(groups(set(fp), pairs(set(fp)))))


def test_links_in_crowded_halves(spark):
    """Tables with keys that far more than HOT fingerprints share connect what brute force connects."""
    rng = random.Random(1)
    fps = {rng.getrandbits(64) for _ in range(50)}
    for half in (0, 32):
        core = rng.getrandbits(64)
        for _ in range(150):
            fps.add(core ^ sum(1 << b for b in {rng.randrange(32) + half for _ in range(rng.randrange(1, 9))}))
            fps.add(core ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
            fps.add(core ^ 1 << rng.randrange(64))
    signed = lambda x: x - 2**64 * (x >= 2**63)
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    found = simhash.links(df).collect()
    assert all((r.a ^ r.b).bit_count() <= 2 if r.a * r.b >= 0 else ((r.a % 2**64) ^ (r.b % 2**64)).bit_count() <= 2 for r in found)
    mine = {frozenset(g) for g in groups(fps, [(r.a % 2**64, r.b % 2**64) for r in found])}
    assert mine == {frozenset(g) for g in groups(fps, pairs(fps))}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 300)] + [(500, i) for i in range(501, 600)] + [(7, 7)]
    nodes = spark.range(700).withColumnRenamed("id", "node")
    got = {r.node: r.component for r in components(nodes, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 100 if 100 <= n <= 300 else 500 if 500 <= n < 600 else n for n in range(700)}


def stripped(rows):
    seen = defaultdict(list)
    for k, r in enumerate(rows):
        w = words(r.text)
        for i in range(len(w) - 34):
            seen[tuple(w[i : i + 35])].append((k, i))
    gone = defaultdict(set)
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                gone[k] |= set(range(i, i + 35))
    return [(r.doc_id, len(words(r.text)), len(gone[k]), " ".join(w for i, w in enumerate(words(r.text)) if i not in gone[k])) for k, r in enumerate(rows)]


def overlapping(spark):
    """Passages cut at all places, shared in part, repeated within a document, periodic, and at both ends."""
    rng = random.Random(2)
    new = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    long, rows = new(300), []
    for k in range(60):
        a = rng.randrange(250)
        rows.append(new(rng.randrange(40)) + long[a : a + rng.randrange(30, 90)] + new(rng.randrange(40)))
    p = new(50)
    rows += [p + new(3) + p, new(34), new(35), p[:35], p[15:], ["z"] * 80, ["y"] * 35, (new(7) * 20), long, long]
    df = [(i, " ".join(r), None) for i, r in enumerate(rows)] + [(None, " ".join(p), 1), (3, None, 2), (4, "", 3)]
    return spark.createDataFrame(df, "doc_id long, text string, n_words int").repartition(5)


@pytest.mark.parametrize("which", ["odd", "docs", "overlapping"])
@pytest.mark.parametrize("bits", [27, 21])
def test_repeated_windows(which, bits, request, spark):
    """Also with a narrow sketch."""
    df = overlapping(spark) if which == "overlapping" else request.getfixturevalue(which)
    got = substring.strip_repeats(df, bits)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()) == Counter(stripped(df.collect()))
    assert set(df.columns) <= set(got.columns)


def test_saturated_sketch_changes_nothing(docs, monkeypatch):
    """A sketch that lets everything pass leaves all the work to the exact count."""
    import numpy as np

    monkeypatch.setattr(substring, "merged_sketch", lambda docs, bits: np.full((substring.ROWS, 1 << (bits - 3)), 255, np.uint8))
    got = substring.strip_repeats(docs, 21)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()) == Counter(stripped(docs.collect()))


def test_sketch_never_undercounts(docs):
    import numpy as np

    bits = substring.merged_sketch(docs)
    anchors = [g for _, d in substring._chunks(pa.array([r.text for r in docs.collect()])) for c in [substring._Chunk(d)] for g in c.grams[np.unique(c.anchor)].tolist()]
    twice = np.array([g for g, n in Counter(anchors).items() if n > 1], dtype=np.uint64)
    for r in range(substring.ROWS):
        k = substring._counters(twice, r, substring.WIDTH_BITS).astype(np.int64)
        assert len(k) and ((bits[r, k >> 3] >> (7 - (k & 7))) & 1).all()


def test_empty(odd):
    none = odd.where("false")
    assert simhash.clusters(none, ["doc_id"]).count() == simhash.keep_one(none).count() == substring.strip_repeats(none).count() == 0


def test_repeated_ids_keep_their_texts(spark):
    rows = [(1, "one two three four five six"), (1, "seven eight nine ten eleven twelve"), (2, "one two three four five six")]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == rows[:2]
