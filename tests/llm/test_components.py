"""Connected components against union-find, and the work of small inputs."""

import random

import pytest

from helixtable.llm import common


def union_find(links):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            up[b] = a
    return {(x, find(x)) for x in list(up)}


def chains():
    """A path, a star, pairs, a link of a node to itself and random links."""
    rng = random.Random(1)
    rows = [(i, i + 1) for i in range(60)] + [(500, 501 + i) for i in range(40)] + [(700 + 2 * i, 701 + 2 * i) for i in range(9)] + [(900, 900)]
    return rows + [(1000 + rng.randrange(80), 1000 + rng.randrange(80)) for _ in range(70)]


@pytest.mark.parametrize("jumps", [common.JUMPS, 3])
def test_components_against_union_find(spark, monkeypatch, jumps):
    monkeypatch.setattr(common, "JUMPS", jumps)
    got = common.components(None, spark.createDataFrame(chains(), "a long, b long"))
    assert {(r.node, r.component) for r in got.collect()} == union_find(chains())


def test_no_links(spark):
    nodes = spark.createDataFrame([(3,), (1,)], "node long")
    assert {tuple(r) for r in common.components(nodes, spark.createDataFrame([], "a long, b long")).collect()} == {(3, 3), (1, 1)}


def test_rounds_of_few_links_do_not_shuffle(spark):
    """Before, each round of few links had several shuffles with all their partitions: their tasks' events filled the disk on check_h."""
    conf = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        spark.sparkContext.setJobGroup("components", "components")
        common.components(None, spark.createDataFrame(chains(), "a long, b long")).collect()
    finally:
        spark.sparkContext.setJobGroup("", "")
        for k, v in before.items():
            spark.conf.set(k, v)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("components") for s in tracker.getJobInfo(j).stageIds}
    infos = [tracker.getStageInfo(s) for s in stages]
    assert sum(i.numCompletedTasks for i in infos if i) < 5 * 61
