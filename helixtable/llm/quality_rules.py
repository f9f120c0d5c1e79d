"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule's cost and rejections are estimated on a sample; the rules then run in the order of rejections per cost, and a
document that one rule rejects is not shown to the next. Where only the verdict is asked for (keep_good), a rule's features are
computed behind the rules before it too. The verdict is the conjunction of all rules, so the order changes the cost and
never the result.

Defined results: a null or blank text has no words and fails the base rule; long texts are taken whole; equal rows get
equal results; an empty table gives an empty table; further columns stay as they are, also those that are named like
a feature (keep_good) or are replaced by it (cascade). A rule whose condition is null does not reject.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtable.llm.common import SPACE, fresh, n_words, settled, words

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_WORK = 2000, 16_384, 6_000_000


@dataclass(frozen=True)
class Rule:
    """reject: true for a document to go; it may use the text, n_words and the features that it needs."""

    name: str
    reject: Column
    needs: tuple[str, ...] = ()


def base_rule() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def base_rules() -> list[Rule]:
    """The base rule's two halves, for a cascade that computes features as it goes."""
    return [Rule("short", F.col("n_words") < 50), Rule("repeats", F.col("n_repeat_words") * 100 > F.col("n_words") * 50, ("n_repeat_words",))]


def default_rules() -> list[Rule]:
    """The library's rules for prose, with the usual limits for web text; shares are of words or of lines that have a word.

    Too many symbols of markup, too many repeated lines, words too short or too long on average, too few words with a letter, too
    many words in capitals, too many doubled marks.
    """
    n, text = F.col("n_words"), F.col("text")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    return [
        Rule("symbols", F.col("n_symbols") * 10 > n, ("n_symbols",)),
        Rule("dup_lines", F.col("n_dup_lines") * 10 > count(r"(?m)^.*[^\x20\x09-\x0D].*$") * 3, ("n_dup_lines",)),
        Rule("word_length", (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 10 * n), ("word_chars",)),
        Rule("letters", count(r"[^\x20\x09-\x0D\p{L}]*+\p{L}[^\x20\x09-\x0D]*+") * 10 < n * 8),
        Rule("capitals", count(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{Ll}]*?\p{Lu}{2}[^\x20\x09-\x0D\p{Ll}]*+(?![^\x20\x09-\x0D])") * 10 > n * 3),
        Rule("emphasis", count(r"[!?]{2,}") * 10 > n),
    ]


def _barrier(value: Column) -> Column:
    """value, behind the partition's number, which is not deterministic to the optimizer: it so keeps later filters above the column
    instead of putting its whole expression into the filter, where lambdas would compute it again for each element."""
    return F.when(F.spark_partition_id() >= 0, value)


def with_feature(df: DataFrame, name: str) -> DataFrame:
    """df(text, ...) with one of FEATURES (a long) of the whole text.

    A 3-word window is compared by a 64-bit hash chained over its words, within one document. Windows are sorted only in
    documents where some window repeats; repeated positions then cover min(3, distance to the one before) words each.
    """
    text = F.col("text")
    zero = F.lit(0).cast("long")
    if name == "n_words":
        return df.withColumn(name, _barrier(n_words(text)))
    if name == "word_chars":  # runs of blanks are left out, so that no array of words is needed
        return df.withColumn(name, _barrier(F.coalesce(F.length(F.translate(text, SPACE, "")), zero).cast("long")))
    if name == "n_symbols":
        return df.withColumn(name, _barrier(F.coalesce(F.regexp_count(text, F.lit("[#*$%&|<>]")), zero).cast("long")))
    tmp = fresh(df, "part_of_feature")
    col = F.col(tmp)
    if name == "n_dup_lines":
        lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
        return df.withColumn(tmp, lines).withColumn(name, _barrier(F.coalesce(F.size(col) - F.size(F.array_distinct(col)), zero).cast("long"))).drop(tmp)
    at = lambda i: F.get(col, i)
    df = df.withColumn(tmp, words(text))
    grams = F.transform(F.sequence(F.lit(0), F.size(col) - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))
    df = df.withColumn(tmp, F.when(F.size(col) >= 3, grams).otherwise(F.array().cast("array<bigint>")))
    ordered = F.sort_array(F.transform(col, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn(tmp, F.when(F.size(F.array_distinct(col)) < F.size(col), ordered))
    again = F.filter(col, lambda e, k: (at(k - 1)["h"].eqNullSafe(e["h"])) | (at(k + 1)["h"].eqNullSafe(e["h"])))
    df = df.withColumn(tmp, F.sort_array(F.transform(again, lambda e: e["i"])))
    covered = F.aggregate(
        col,
        F.struct(zero.alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"],
    )
    return df.withColumn(name, _barrier(F.coalesce(covered, zero))).drop(tmp)


def with_features(docs: DataFrame, names: tuple[str, ...] = FEATURES) -> DataFrame:
    """docs with the named features, which replace columns of their names."""
    df = docs.select([c for c in docs.columns if c not in names])
    for name in names:
        df = with_feature(df, name)
    return df


@dataclass(frozen=True)
class Estimate:
    """What a rule did to the sample: rows it rejects alone, seconds over all rows."""

    rule: Rule
    rejects: int
    seconds: float


def sample_of(docs: DataFrame, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """About `rows` texts of at most most_bytes bytes, spread over docs by hash; at most 2 * rows: below 64 MB with the defaults. It sets the order only."""
    every = max(1, docs.count() // rows)
    part = docs.select("text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= most_bytes)
    if every > 1:
        part = part.where(F.pmod(F.xxhash64("text", F.lit(11)), F.lit(every)) == 0)
    return settled(part.limit(2 * rows).coalesce(1))


def estimate_rules(sample: DataFrame, rules: list[Rule]) -> tuple[list[Estimate], list[list[bool]]]:
    """An Estimate for each rule, and for each row of the sample which rules reject it.

    The sample is repeated until it makes SAMPLE_WORK bytes, so that a rule's work stands out against a job's own cost; what a job over
    the same rows takes that only counts words is subtracted. The better of two runs counts.
    """
    columns = [F.coalesce(r.reject, F.lit(False)).alias(f"r{i}") for i, r in enumerate(rules)]
    needs = tuple(dict.fromkeys(("n_words", *[f for r in rules for f in r.needs])))
    hits = [list(r) for r in with_features(sample, needs).select(columns).collect()]  # booleans of at most 4000 rows
    size = sample.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    times = max(1, min(1000, -(-SAMPLE_WORK // max(1, size))))
    repeated = sample.select(F.explode(F.array_repeat("text", times)).alias("text"))

    def seconds(reject: Column, features: tuple[str, ...]) -> float:
        took = []
        for _ in range(2):
            began = time.perf_counter()
            with_features(repeated, features).agg(F.count_if(reject)).collect()
            took.append(time.perf_counter() - began)
        return min(took)

    base = seconds(F.col("n_words") < 0, ("n_words",))  # every cascade counts the words first
    costs = [max(1e-3, seconds(r.reject, tuple(dict.fromkeys(("n_words", *r.needs)))) - base) for r in rules]
    return [Estimate(r, sum(h[i] for h in hits), c) for i, (r, c) in enumerate(zip(rules, costs))], hits


def order_rules(docs: DataFrame, rules: list[Rule]) -> list[Rule]:
    """rules by what they reject for their cost, each among the sample's rows that the rules before it leave.

    Half a row is added to the rejections, so that of rules that reject nothing there the cheapest comes first. An empty
    sample leaves the order as it is.
    """
    sample = sample_of(docs)
    if not sample.limit(1).count():
        return rules
    estimates, left = estimate_rules(sample, rules)
    costs, open_rules, out = [e.seconds for e in estimates], list(range(len(rules))), []
    while open_rules:
        best = max(open_rules, key=lambda i: (sum(row[i] for row in left) + 0.5) / costs[i])
        out.append(rules[best])
        open_rules.remove(best)
        left = [row for row in left if not row[best]]
    return out


def cascade(docs: DataFrame, rules: list[Rule] | None = None, ordered: bool = False) -> DataFrame:
    """docs with the features, base_failed and kept.

    rules: default_rules() if none; ordered: they are in their final order already. CASE stops at the first rule that
    rejects, so later rules cost nothing for that row; the features are asked for and computed for all rows here.
    """
    rules = default_rules() if rules is None else rules
    rules = rules if ordered or len(rules) < 2 else order_rules(docs, rules)
    df = with_features(docs.select([c for c in docs.columns if c not in ("base_failed", "kept")])).withColumn("base_failed", base_rule())
    verdict = F.when(F.col("base_failed"), False)
    for r in rules:
        verdict = verdict.when(F.coalesce(r.reject, F.lit(False)), False)
    return df.withColumn("kept", verdict.otherwise(True))


def keep_good(docs: DataFrame, rules: list[Rule] | None = None, ordered: bool = False) -> DataFrame:
    """The rows of docs that the cascade keeps, with the columns of docs.

    The base rule's halves are rules of the cascade too. Each rule is a filter, and the features that it needs are computed
    between it and the rules before.
    """
    rules = base_rules() + (default_rules() if rules is None else rules)
    rules = rules if ordered else order_rules(docs, rules)
    aside = {c: fresh(docs, f"own_{c}") for c in docs.columns if c in FEATURES}
    df, ready = with_feature(docs.withColumnsRenamed(aside), "n_words"), {"n_words"}
    for r in rules:
        for f in r.needs:
            if f not in ready:
                df, ready = with_feature(df, f), ready | {f}
        df = df.where(~F.coalesce(r.reject, F.lit(False)))
    return df.select([F.col(aside.get(c, c)).alias(c) for c in docs.columns])
