"""Columns that clash with internal ones, very long texts, and odd or empty rows through all stages of the pipeline."""

from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helixtable.llm import compression_classifier, mixing, near_copies, packing, quality_rules, sharding, simhash, substring, token_counts
from tests.llm.conftest import words
from tests.llm.test_native import features
from tests.llm.test_near_copies import fingerprint
from tests.llm.test_near_copies import stripped

CLASHING = ["id", "_w", "_text", "_k", "_rid", "_copy", "node", "fp", "h", "u", "s", "key", "n_words", "size", "copies", "item", "text_of_row", "part", "band", "component", "row", "spans", "n", "near_copy", "own_n_words"]
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def clashing(odd):
    return odd.select("*", *[F.lit(f"mine {c}").alias(c) for c in CLASHING])


def mine(df, but=()):
    rows = df.select([c for c in df.columns if c in CLASHING and c not in but]).collect()
    assert rows and all(r[c] == f"mine {c}" for r in rows for c in r.asDict())
    return df


def test_clashing_columns(clashing):
    same = clashing.columns
    for kept in (quality_rules.keep_good(clashing), simhash.keep_one(clashing), near_copies.keep_one(clashing), mixing.take(clashing)):
        assert kept.columns == same
        mine(kept)
    mine(quality_rules.cascade(clashing), ("n_words",))
    mine(substring.strip_repeats(clashing), ("n_words",))
    carry = ["doc_id", *CLASHING]
    mine(simhash.clusters(clashing, carry), ("fp", "component"))
    mine(mixing.mix(clashing, carry), ("size", "copies"))
    mine(packing.pack(clashing, BPE, carry))
    mine(token_counts.prefix_table(clashing, PIECES, carry))
    labels = clashing.sparkSession.createDataFrame([(1, 1), (9, 0)], "doc_id long, quality int")
    mine(compression_classifier.classify(clashing, labels, carry))
    mine(sharding.shard_documents(clashing))
    assert sharding.assign(clashing).count() == clashing.count()


@pytest.fixture(scope="module")
def long_texts(spark):
    """10 MB without white space, 10 MB of words, and a short text."""
    return spark.createDataFrame([(1, "x" * 10_000_000, "a"), (2, " ".join(f"w{i % 100_000}" for i in range(1_500_000)), "a"), (3, "a b c", "b")], "doc_id long, text string, source string").repartition(2)


def test_very_long_texts(long_texts):
    rows = {r.doc_id: r.text for r in long_texts.collect()}
    for r in quality_rules.cascade(long_texts).collect():
        assert r.n_words == len(words(rows[r.doc_id])) and r.word_chars == sum(map(len, words(rows[r.doc_id])))
    assert {r.doc_id for r in near_copies.keep_one(long_texts).collect()} == {1, 2, 3}
    assert {r.doc_id: (r.n_words, r.n_removed) for r in substring.strip_repeats(long_texts).collect()} == {1: (1, 0), 2: (1_500_000, 1_500_000), 3: (3, 0)}
    assert sum(r.size for r in mixing.mix(long_texts, ["doc_id"]).collect()) == 1_500_004
    assert {r.doc_id: r.fp % 2**64 for r in simhash.clusters(long_texts.where("doc_id <> 2"), ["doc_id"]).collect()} == {i: fingerprint(rows[i]) for i in (1, 3)}
    assert sharding.assign(long_texts).count() == 3


def test_identifiers_that_are_no_numbers(spark, odd):
    """Each stage gives the same rows for identifiers as text, nulls among them."""
    number = odd.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars"))
    # text of equal length, so that both kinds have one order
    named = lambda df: df.withColumn("doc_id", F.concat(F.lit("a-"), F.lpad(F.col("doc_id").cast("string"), 20, "0")))
    for name in ("quality_rules", "simhash_near_copies", "repeated_passages", "source_mix"):
        stage = dict(corpus_pipeline.STAGES)[name]
        got = stage(spark, named(number), "")
        if name != "source_mix":  # its draws depend on the rows' hashes
            assert Counter(map(str, got.collect())) == Counter(map(str, named(stage(spark, number, "")).collect()))
        assert got.count() > 0 and got.schema["doc_id"].dataType.simpleString() == "string"
    assert dict(corpus_pipeline.STAGES)["sequence_packing"](spark, named(number), "").count() > 0
    assert simhash.keep_one(named(number)).count() == simhash.keep_one(number).count()


def test_stages_on_odd_and_empty_rows(spark, odd):
    docs = odd.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars"), F.lit("mine").alias("_k"), F.lit("mine").alias("node"))
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_rules"](spark, docs, "")
    assert Counter(r.doc_id for r in good.collect()) == Counter(r.doc_id for r in docs.collect() if not features(r.text)[-1])
    one = stages["simhash_near_copies"](spark, docs, "")
    assert {r.text for r in one.collect() if words(r.text)} == {r.text for r in docs.collect() if words(r.text)}
    cut = stages["repeated_passages"](spark, docs, "")
    rows = docs.collect()
    want = Counter((i, kept if gone else r.text) for (i, _, gone, kept), r in zip(stripped(rows), rows))
    assert Counter((r.doc_id, r.text) for r in cut.collect()) == want
    mixed = stages["source_mix"](spark, docs, "")
    packed = stages["sequence_packing"](spark, docs, "")
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in rows}
    for stage in (good, one, cut, mixed):
        assert stage.columns == docs.columns
        assert all(r["_k"] == r.node == "mine" for r in stage.collect())
    none = docs.where("false")
    assert [f(spark, none, "").count() for f in stages.values()] == [0] * 5
