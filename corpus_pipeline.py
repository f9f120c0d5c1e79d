"""A training-data pipeline from five of the llm operators: rules, near copies, repeated passages, source mix, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its result is written and read again as the next
one's docs. All stages but the last return the columns of documents; n_chars follows the text where a stage changes it. The
mix takes documents more than once where a source's target asks for it, so doc_id may repeat from there on.

Defined results, for all stages: further columns stay (but in the packing, which carries doc_id alone), whatever their names; an
empty table gives an empty table; rows with a null doc_id are documents like others. Each stage's own are in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtable.llm import mixing, packing, quality_rules, substring
from helixtable.llm import near_copies as shingle_copies
from helixtable.llm.common import stash
from helixtable.ship import ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no rule rejects. Null and blank texts have fewer than 50 words and go; equal rows share their verdict."""
    ship(spark)
    return quality_rules.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of documents whose 5-word shingles are alike by 0.8 or more: the smallest doc_id, nulls last, then by text hash.

    SimHash finds the copies whose fingerprints are close; texts that it leaves in different groups are compared by shingles. Null and blank texts are one group; a row that repeats the identifier and the text of the one that stays goes.
    """
    ship(spark)
    return shingle_copies.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words under repeated windows; texts that lose nothing stay as they are, null ones too.

    All occurrences of a repeated window go, those in repeated rows too; a text of which nothing is left becomes empty.
    """
    ship(spark)
    out = substring.strip_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return out.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them, 0 to 3 times. Null sources are one source, the last; null texts have size 0; rows
    that are equal in all columns share their copies."""
    ship(spark)
    return mixing.take(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens. A null text is an empty one, of the closing id alone;
    equal rows are documents of their own."""
    import public_tokenizers

    ship(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"], public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("source_mix", mix_sources),
    ("sequence_packing", pack_sequences),
]

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stash(docs)
    return docs
