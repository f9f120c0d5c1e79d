"""NN-descent against brute force."""

from collections import Counter

import numpy as np
import pytest

from helixtable.llm import nn_descent


def brute(rows, threshold=0.9):
    ok = [i for i, (_, v) in enumerate(rows) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    link = {i: set() for i in range(len(rows))}
    for i in ok:
        a = np.array(rows[i][1], dtype=np.float64)
        for j in ok:
            b = np.array(rows[j][1], dtype=np.float64)
            if i != j and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                link[i].add(j)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        names = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(names, default=None)
        out.append((vec_id, len(link[i]), least, vec_id is not None and vec_id == least))
    return Counter(out)


def data():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(150, 16))
    rows = [list(map(float, v)) for v in base]
    rows += [list(map(float, base[i] + 0.25 * rng.normal(size=16))) for i in range(40)]
    rows += [list(map(float, base[0] + 0.15 * rng.normal(size=16))) for _ in range(60)]  # more links than a list holds
    rows += [rows[3]] * 30 + [[2 * x for x in rows[3]]]
    for k in range(25):  # a chain, each near the next
        t = 0.3 * k
        rows.append([float(np.cos(t)), float(np.sin(t))] + [0.0] * 14)
    rows += [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [1.0, 2.1]]
    out = list(enumerate(rows, 1000))
    return out + [out[5], (None, rows[5]), (None, None)]


def test_against_brute_force(spark):
    rows = data()
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, kept string").repartition(4)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = Counter(tuple(r) for r in nn_descent.near_duplicates(df).collect())
    assert got == brute(rows)


def test_large_components_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", 16)
    rng = np.random.default_rng(2)
    rows = [(i, list(map(float, np.ones(8) + (0.2 if i % 3 else 0.02) * rng.normal(size=8)))) for i in range(120)]
    got = nn_descent.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_empty(spark):
    assert nn_descent.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_low_recall_is_not_returned(spark, monkeypatch):
    pairs = nn_descent.bucket_pairs
    monkeypatch.setattr(nn_descent, "bucket_pairs", lambda *a: pairs(*a).where("false"))
    monkeypatch.setattr(nn_descent, "RETRIES", 0)
    rows = [(i, v) for i, v in enumerate([[1.0, 0.0], [1.0, 0.1], [0.0, 1.0]])]
    with pytest.raises(RuntimeError, match="links"):
        nn_descent.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))


@pytest.mark.parametrize("n", [2000, 10**6, 3 * 10**7])
def test_tables_grow_with_bits(n):
    hit = (1 - np.arccos(0.9) / np.pi) ** nn_descent.table_bits(n, nn_descent.LEAF)
    assert (1 - hit) ** nn_descent.tables_for(n, 0.9) <= 0.001
