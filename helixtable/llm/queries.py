"""The subpackage's registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtable.llm import chat, exact_dedup, filter_audit, lexical_search
from helixtable.llm.common import table


def op1_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixtable.llm.nn_descent import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixtable.llm.quality_rules import cascade

    df = cascade(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixtable.llm.sharding import assign

    return assign(table(spark, sf_dir, "documents"), shards=24)


def op4_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixtable.llm.mixing import mix

    df = mix(table(spark, sf_dir, "documents"), ["doc_id"])
    return df.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op5_countmin_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixtable.llm.substring import strip_repeats

    df = strip_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return df.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op6_compression_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixtable.llm.compression_classifier import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])


def op7_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixtable.llm.chat import format_chats

    return format_chats(table(spark, sf_dir, "conversations"))


def op8_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from helixtable.llm.token_counts import prefix_table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counts = prefix_table(docs, public_tokenizers.path("piece_bpe_32k.model"), ["doc_id", "n_bytes"])
    n = F.when(F.size("prefix_counts") > 0, F.element_at("prefix_counts", -1)).otherwise(0).cast("long")
    return counts.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > 4096).alias("over_limit"))


def op9_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from helixtable.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"], public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op10_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixtable.llm.simhash import clusters

    df = clusters(table(spark, sf_dir, "documents"), ["doc_id"])
    return df.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_packed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_blocked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_nn_descent,
        op2_quality_cascade,
        op3_minimax_shards,
        op4_pivotal_mix,
        op5_countmin_substrings,
        op6_compression_scores,
        op7_snapshot_collapse,
        op8_prefix_tokens,
        op9_genetic_packing,
        op10_simhash_groups,
        op11_packed_audit,
        op12_blocked_search,
        op13_chunk_recipes,
    )
}

#: DuckDB SQL by query, where SQL can express it.
ORACLES: dict[str, str] = {"op7_snapshot_collapse": chat.SQL, "op11_packed_audit": filter_audit.SQL, "op12_blocked_search": lexical_search.SQL, "op13_chunk_recipes": exact_dedup.SQL}
