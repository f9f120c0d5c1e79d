"""Filter interaction audit by wide packed counters.

Which filters a document fails, and whether it is good or toxic, is a mask of a few bits. Each mask maps to one big integer, whose
64-bit fields hold the outcomes of all steps of all orders of the filters: for five filters 600 steps of six counters. The masks'
integers are summed per part of the corpus, in every task first, then in SALTS sums, then in one, and unpacked at the end. A field counts rows,
of which there are fewer than 2**63, so that none runs over into the next.

A document that is identical to one with a smaller identifier is found by SHA-256: the least identifier of each digest is a
grouping that is merged before its shuffle, and a row is a first one where its digest and identifier are among those, a join that
no large group of copies can make uneven. Only digests, identifiers and masks are shuffled.

Defined results: a null text counts as empty; a null or empty lang is the part ''; a row with a null identifier is no copy and has no
labels; rows repeated in full are rows of their own and no copies of each other; of several labels of one identifier, one that
says 1 counts; an empty table gives an empty table; further columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtable.llm.common import slices, stash

LETTERS = "ABCDE"
COUNTERS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
#: First sums of a part, and most parts whose sums a task holds.
SALTS, HELD = 64, 1000
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20
UPPER, SYMBOLS = bytes(range(ord("A"), ord("Z") + 1)), b"#$%&*|"
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _n_words(data: bytes) -> tuple[int, int]:
    """Words and distinct words; a long text is split piece by piece."""
    seen, n, at = set(), 0, 0
    while at < len(data):
        end = len(data)
        if end - at > PIECE and (space := SPACE.search(data, at + PIECE)):
            end = space.end()
        found = data[at:end].split()
        n += len(found)
        seen.update(found)
        at = end
    return n, len(seen)


def failures(text: str) -> int:
    """The bits of the filters A to D that a text fails."""
    data = text.encode()
    n, distinct = _n_words(data)
    capitals = len(data) - len(data.translate(None, UPPER))
    fails = (n < 200, 100 * distinct < 50 * n, 100 * capitals > 3 * len(text), len(data.translate(None, SYMBOLS)) < len(data))
    return sum(1 << i for i, f in enumerate(fails) if f)


def _scanned(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text, and mask of A to D."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for batch in batches for x in slices(batch, "text")):
            texts = [t.as_py() for t in b.column("text")]
            new = [pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary()), pa.array([failures(t) for t in texts], pa.int32())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), *new], names=["doc_id", "part", "digest", "mask"])

    given = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    return given.mapInArrow(part, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, part string, digest binary, mask int")


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (the failed filters from bit 0 on, then good, then toxic) and n (rows) of the documents."""
    rows = stash(_scanned(docs).groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")))
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("first", F.lit(True))
    marks = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    bit = lambda condition, i: F.when(condition, F.lit(1 << i)).otherwise(0)
    known = rows.where("doc_id is not null").join(firsts, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    whole = F.col("mask") + bit(F.col("first").isNull(), 4) + bit(F.col("good"), 5) + bit(F.col("toxic"), 6)
    return known.select("part", whole.alias("mask"), "n").union(rows.where("doc_id is null").select("part", "mask", "n"))


@cache
def _packed(letters: str) -> list[int]:
    """By mask, the integer of its outcomes."""
    k, out = len(letters), []
    for mask in range(1 << k + 2):
        fields = np.zeros((len(orders(letters)) * k, len(COUNTERS)), dtype="<u8")
        good, toxic = mask >> k & 1, mask >> k + 1 & 1
        for i, order in enumerate(orders(letters)):
            gone = False
            for step, letter in enumerate(order):
                own = 1 << letters.index(letter)
                fails, only = bool(mask & own), mask & (1 << k) - 1 == own
                removed = fails and not gone
                fields[i * k + step] = (not fails and not gone, removed, fails and gone, only, removed and good, removed and toxic)
                gone = gone or fails
        out.append(int.from_bytes(fields.tobytes(), "little"))
    return out


def orders(letters: str) -> list[str]:
    return ["".join(p) for p in permutations(letters)]


def _bytes(letters: str) -> int:
    return len(orders(letters)) * len(letters) * len(COUNTERS) * 8


def _row(part: str, salt: int, total: int, letters: str) -> dict:
    return {"part": part, "salt": salt, "total": total.to_bytes(_bytes(letters), "little")}


SUMS = pa.schema([("part", pa.string()), ("salt", pa.int32()), ("total", pa.binary())])


def _sum(totals: pa.ChunkedArray) -> int:
    return sum(int.from_bytes(t.as_py(), "little") for t in totals)


def audit(masked: DataFrame, letters: str = LETTERS) -> DataFrame:
    """part, filter_order, step, the counters and shapley for masked(part, mask, n): one row for each part, order of the letters and step."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, totals, salt = _packed(letters), defaultdict(int), TaskContext.get().partitionId() % SALTS
        for b in batches:
            for part, mask, n in zip(*(b.column(i).to_pylist() for i in range(3))):
                totals[part] += packed[mask] * n
            if len(totals) > HELD:
                yield pa.RecordBatch.from_pylist([_row(p, salt, t, letters) for p, t in totals.items()], SUMS)
                totals.clear()
        yield pa.RecordBatch.from_pylist([_row(p, salt, t, letters) for p, t in totals.items()], SUMS)

    def merge(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([_row(table["part"][0].as_py(), table["salt"][0].as_py(), _sum(table["total"]), letters)], SUMS)

    def unpack(table: pa.Table) -> pa.Table:
        fields = np.frombuffer(_sum(table["total"]).to_bytes(_bytes(letters), "little"), dtype="<u8").astype(np.int64).reshape(-1, len(COUNTERS))
        steps = [(o, i + 1, letter) for o in orders(letters) for i, letter in enumerate(o)]
        removed = defaultdict(int)
        for (_, _, letter), row in zip(steps, fields.tolist()):
            removed[letter] += row[COUNTERS.index("removed")]
        columns = {"part": [table["part"][0].as_py()] * len(steps), "filter_order": [s[0] for s in steps], "step": pa.array([s[1] for s in steps], pa.int32())}
        columns |= {c: fields[:, i] for i, c in enumerate(COUNTERS)} | {"shapley": [removed[s[2]] for s in steps]}
        return pa.table(columns)

    sums = masked.select("part", "mask", "n").mapInArrow(add, "part string, salt int, total binary")
    merged = sums.groupBy("part", "salt").applyInArrow(merge, "part string, salt int, total binary")
    return merged.groupBy("part").applyInArrow(unpack, f"part string, filter_order string, step int, {', '.join(f'{c} long' for c in COUNTERS)}, shapley long")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over docs(doc_id, text, lang) and labels(doc_id, quality, toxic)."""
    return audit(masks(docs, labels))


#: DuckDB SQL for filter_audit over the tables documents and labels.
SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), failed AS (
    SELECT part, [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
        regexp_matches(t, '[#$%&*|]'), doc_id > min(doc_id) OVER (PARTITION BY t)] AS fails, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
    FROM texts LEFT JOIN labels USING (doc_id)
), masks AS (SELECT part, fails, good, toxic, count(*) AS n FROM failed GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM l a, l b, l c, l d, l e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), dealt AS (
    SELECT *, list_transform([1, 2, 3, 4, 5], lambda k: fails[instr('ABCDE', substr(filter_order, k, 1))]) AS f FROM masks CROSS JOIN orders
), firsts AS (SELECT *, coalesce(list_position(f, true), 6) AS gone FROM dealt),
steps AS (
    SELECT part, filter_order, step, CAST(sum(CASE WHEN gone > step THEN n ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN gone = step THEN n ELSE 0 END) AS BIGINT) AS removed,
        CAST(sum(CASE WHEN gone < step AND f[step] THEN n ELSE 0 END) AS BIGINT) AS redundant,
        CAST(sum(CASE WHEN f[step] AND len(list_filter(f, lambda x: x)) = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
        CAST(sum(CASE WHEN gone = step AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost, CAST(sum(CASE WHEN gone = step AND toxic THEN n ELSE 0 END) AS BIGINT) AS toxic_lost
    FROM firsts CROSS JOIN (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INT) AS step) GROUP BY part, filter_order, step
)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)) AS BIGINT) AS shapley FROM steps
"""
