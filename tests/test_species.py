"""Species that are rejected or missing, tags that clash, and wide rows that repeat."""

from collections import Counter

from helixtable.operators import hits as H
from helixtable.operators import species as S

FIELDS = "species string, aln_len string, bitscore string, note string"


def test_a_bad_value_rejects_its_species_alone(spark):
    rows = [("a", "1", "2.5", "x"), ("a", None, None, None), ("b", "7", "8", "x"), ("b", "7z", "8", "x"), ("b", "6z", "8q", "x"), (None, "1", "1", "x"), ("c", "", "1", "x"), ("d", "3", "4", "x"), ("d", "3", "4", "x")]
    good, counts = S.cast_by_species(spark.createDataFrame(rows, FIELDS).repartition(3))
    assert Counter(tuple(r) for r in good.collect()) == Counter([("a", 1, 2.5, "x"), ("a", None, None, None), (None, 1, 1.0, "x"), ("d", 3, 4.0, "x"), ("d", 3, 4.0, "x")])
    assert {r.species: (r.rows, r.bad_rows, r.reason) for r in counts.collect()} == {"a": (2, 0, None), "b": (3, 2, "aln_len: 7z"), None: (1, 0, None), "c": (1, 1, "aln_len: "), "d": (2, 0, None)}
    bad_null = spark.createDataFrame([(None, "x", "1", "x"), ("a", "1", "1", "x")], FIELDS)
    assert [r.species for r in S.cast_by_species(bad_null)[0].collect()] == ["a"]


def test_report_of_listed_species(spark):
    df = spark.createDataFrame([("a", "1", "1", ""), ("b", "q", "1", ""), ("other", "z", "1", "")], FIELDS)
    names = spark.createDataFrame([("a",), ("a",), ("b",), ("gone",)], "species string")
    good, report = S.union_with_report(df, names)
    assert [r.species for r in good.collect()] == ["a"]
    assert sorted(tuple(r) for r in report.collect()) == [("a", "taken", 1, 0, None), ("b", "rejected", 1, 1, "aln_len: q"), ("gone", "missing", 0, 0, None)]
    good, report = S.union_with_report(df.where("false"), names)
    assert good.count() == 0 and {r.status for r in report.collect()} == {"missing"}


def test_tags_are_unique(spark):
    rows = [(i, None if i % 2 else "") for i in range(300)] + [(None, None), (None, ""), (None, "-"), (7, None), (7, None)]
    df = spark.createDataFrame(rows, "id long, text string").withColumnRenamed("text", "tag_text")
    for length in (1, 3, 6):
        got = H.unique_tags(df, length).collect()
        tags = {}
        for r in got:
            tags.setdefault(r.tag, set()).add((r.id, r.tag_text))
        assert len(got) == len(rows) and all(len(x) == 1 for x in tags.values()) and len(tags) == len(set(rows))
        assert min(map(len, tags)) >= length
    assert Counter(r.tag for r in H.unique_tags(df, 6).collect()) == Counter(r.tag for r in H.unique_tags(df.repartition(5), 6).collect())
    assert H.unique_tags(df.where("false")).count() == 0


def test_tags_take_one_shuffle(spark):
    df = spark.createDataFrame([(i % 900, "x") for i in range(1000)], "id long, name string")
    tagged = H.unique_tags(df, 1)
    assert tagged._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert len({r.tag for r in tagged.collect()}) == 900


def test_wide_rows(spark, monkeypatch):
    rows = [("a", "x" * 1000, 0.0), ("a", "x" * 1000, -0.0), ("a", "y", None), ("a", "y", None), (None, "y", 1.0), ("y", None, 1.0), ("b", "z", float("nan")), ("b", "z", float("nan"))]
    df = spark.createDataFrame(rows * 3 + [("c", "only", 1.0)], "species string, sequence string, score double")
    want = Counter(map(str, H.dedupe_hits(df).collect()))
    assert len(want) == 6
    for most in (H.REPEATED, 0):
        monkeypatch.setattr(H, "REPEATED", most)
        assert Counter(map(str, H.dedupe_wide(df).collect())) == want
