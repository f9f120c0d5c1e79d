"""Ranked lexical search by dense blocked multiplication.

Every document is scored for every item: the items' terms weigh by how rare they are, and a document's impact for a term saturates
with the term's count and falls with the document's length. All of it is integers but one logarithm.

One scan splits the texts and keeps, of each document, its number of terms and the counts of those terms that an item has; the
statistics come from that table. A second one builds tiles: weights of ITEMS items by the columns that occur in both tiles, times impacts of
these columns by TILE documents, in float64. A tile takes only so many columns that its sums stay below 2**53, so each product is exact in
any order of addition; the tiles' sums are added as 64-bit integers. Every task keeps the best `top` of each item, in order of score and
identifier: documents of a tile are sorted by identifier, and what equals the score of the last one kept stays in until identifiers
are compared. The tasks' lists are merged in SALTS parts an item first and then in one of at most SALTS * top rows.

Items are taken in rounds of at most POSTINGS pairs of item and term (more only where one item has more), which is what is broadcast; each round scans the documents.

Defined results: null and empty texts have no terms; documents without terms count nowhere; rows with one item_id are one item with all their
terms, each once; items without terms give no rows; repeated documents are ranked each on its own; null identifiers come last among
equal scores; identifiers may be of any type that sorts; empty tables give an empty table; further columns are left out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixtable.llm.common import settled, slices, stash

TOP = 50
ITEMS, TILE, COLUMNS = 256, 1024, 4096
POSTINGS = 1 << 20
SALTS = 64
#: Candidates that a task holds before it compares them.
HELD = 200_000
#: Bytes of a text that are split at a time.
PIECE = 1 << 20
#: A term's impact is below this.
IMPACT = 1_000_000
#: Letters of terms as they are, A to Z in lower case, all other ASCII as spaces.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a piece of it at a time."""
    data, at = (text or "").encode().translate(FOLD), 0
    while at < len(data):
        end = data.find(b" ", at + PIECE) if len(data) - at > PIECE else -1
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item and term, each pair once."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for batch in batches for x in slices(batch, "text")):
            at, found = [], []
            for i, t in enumerate(b.column("text")):
                own = {w for ws in terms(t.as_py()) for w in ws}
                at += [i] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(at, pa.int64())), pa.array(found, pa.binary())], names=["item", "term"])

    given = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text"))
    return given.mapInArrow(part, f"item {given.schema['item'].dataType.simpleString()}, term binary").distinct()


def _counted(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """id, n (terms with repeats), terms and tf (numbers and counts of those in the vocabulary) of the documents that have terms, on the shared folder."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for b in (x for batch in batches for x in slices(batch, "text")):
            at, ns, ids, tfs = [], [], [], []
            for i, t in enumerate(b.column("text")):
                n, found = 0, Counter()
                for ws in terms(t.as_py()):
                    n += len(ws)
                    found.update(map(number, ws))
                if n:
                    found.pop(None, None)
                    at.append(i)
                    ns.append(n)
                    ids.append(list(found))
                    tfs.append(list(found.values()))
            columns = [b.column("id").take(pa.array(at, pa.int64())), pa.array(ns, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "terms", "tf"])

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return stash(given.mapInArrow(part, f"id {given.schema['id'].dataType.simpleString()}, n long, terms array<int>, tf array<long>"))


def length_norm(n: int, n_docs: int, total: int) -> int:
    """m of a document with n terms, of n_docs documents with total terms."""
    return 100 - 50 + 50 * n * n_docs // total


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class _Best:
    """The best candidates of each item so far."""

    def __init__(self, n_items: int, kind: pa.DataType, top: int):
        self.top = top
        self.floor = np.ones(n_items, dtype=np.int64)
        self.schema = pa.schema([("item", pa.int32()), ("score", pa.int64()), ("id", kind)])
        self.held = [self.schema.empty_table()]
        self.n = 0

    def add(self, scores: np.ndarray, first_item: int, ids: pa.Array) -> None:
        """scores: items from first_item on by documents, which are in order of their identifiers."""
        rows, at = np.nonzero(scores >= self.floor[first_item : first_item + len(scores), None])
        if not len(rows):
            return
        found = scores[rows, at]
        order = np.lexsort((at, -found, rows))
        rows, at, found = rows[order], at[order], found[order]
        keep = _ranks(rows) < self.top
        self.held.append(pa.table([pa.array((rows[keep] + first_item).astype(np.int32)), pa.array(found[keep]), ids.take(pa.array(at[keep]))], schema=self.schema))
        self.n += int(keep.sum())
        if self.n > HELD:
            self.compare()

    def compare(self) -> pa.Table:
        held = pa.concat_tables(self.held)
        held = held.take(pc.sort_indices(held, sort_keys=[("item", "ascending"), ("score", "descending"), ("id", "ascending")], null_placement="at_end"))
        ranks = _ranks(held["item"].to_numpy())
        last = held.filter(pa.array(ranks == self.top - 1))
        self.floor[last["item"].to_numpy()] = last["score"].to_numpy()
        held = held.filter(pa.array(ranks < self.top))
        self.held, self.n = [held], held.num_rows
        return held


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Place of each entry among those of its key, from 0, in a sorted array."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return np.arange(len(keys)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(keys)]])))


def _products(owner: np.ndarray, columns: np.ndarray, weights: np.ndarray, n_items: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
    """Scores of a tile of items by a tile of documents, as 64-bit integers.

    owner and columns: the tile's pairs of item and term; weights by term; doc, term and impact: the documents' entries.
    """
    shared = np.intersect1d(columns, term)
    scores = np.zeros((n_items, n_docs), dtype=np.int64)
    # sums of so many products are below 2**53
    most = max(1, min(COLUMNS, (2**53 - 1) // (IMPACT * int(max(1, weights.max(initial=1))))))
    for c in (shared[i : i + most] for i in range(0, len(shared), most)):
        w, x = np.zeros((n_items, len(c))), np.zeros((len(c), n_docs))
        for target, rows, keys, values in ((w, owner, columns, weights[columns]), (x.T, doc, term, impact)):
            place = np.searchsorted(c, keys)
            hit = c[np.minimum(place, len(c) - 1)] == keys
            target[rows[hit], place[hit]] = values[hit]
        scores += np.rint(w @ x).astype(np.int64)
    return scores


def _ranked(counted: DataFrame, items: pa.Array, pairs: np.ndarray, weights: np.ndarray, n_docs: int, total: int, item_type: str, top: int) -> DataFrame:
    """item, id and score: each task's best documents. pairs: item and term numbers, in order of items."""
    id_type = counted.schema["id"].dataType.simpleString()
    shared = counted.sparkSession.sparkContext.broadcast((items, pairs, weights))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, pairs, weights = shared.value
        bounds = np.searchsorted(pairs[:, 0], np.arange(0, len(items) + ITEMS, ITEMS))
        best = None
        for b in batches:
            best = best or _Best(len(items), b.column("id").type, top)
            b = b.take(pc.sort_indices(b.select(["id"]), sort_keys=[("id", "ascending")], null_placement="at_end"))
            for at in range(0, b.num_rows, TILE):
                tile = b.slice(at, TILE)
                lengths = pc.list_value_length(tile.column("terms")).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(tile.num_rows), lengths)
                term, tf = tile.column("terms").flatten().to_numpy(zero_copy_only=False), tile.column("tf").flatten().to_numpy(zero_copy_only=False)
                m = np.array([length_norm(n, n_docs, total) for n in tile.column("n").to_pylist()], dtype=np.int64)
                impact = 1_000_000_000 * tf // (1000 * tf + 20 * m[doc])
                for k, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
                    n_items = min(ITEMS, len(items) - k * ITEMS)
                    own = pairs[lo:hi]
                    best.add(_products(own[:, 0] - k * ITEMS, own[:, 1], weights, n_items, doc, term, impact, tile.num_rows), k * ITEMS, tile.column("id"))
        if best:
            for b in best.compare().to_batches():
                yield pa.RecordBatch.from_arrays([items.take(b.column("item")), b.column("id"), b.column("score")], names=["item", "id", "score"])

    return counted.mapInArrow(part, f"item {item_type}, id {id_type}, score long")


def _rounds(pairs: DataFrame) -> DataFrame:
    """pairs with the round of each item: so many rounds that none has more than POSTINGS pairs, or one for each item."""
    n = n_items = None
    while True:
        dealt = pairs.withColumn("round", F.pmod(F.xxhash64("item"), F.lit(n or 1)))
        if n is not None and n >= (n_items or 1) * 4:
            return dealt
        most = dealt.groupBy("round").count().agg(F.max("count")).first()[0] or 0
        if most <= POSTINGS:
            return dealt
        n_items = n_items or pairs.select("item").distinct().count()
        n = max(2 * (n or 1), -(-most // POSTINGS))


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text", top: int = TOP) -> DataFrame:
    """The item's identifier, rank from 1, the document's identifier and score: each item's best documents, top, fewer where fewer score."""
    pairs = _rounds(settled(_item_terms(items, item_col, text_col)))
    item_type, out = pairs.schema["item"].dataType.simpleString(), None
    for (number,) in pairs.select("round").distinct().collect():
        asked = pairs.where(F.col("round") == number).groupBy("item").agg(F.collect_list("term").alias("terms")).toArrow()
        own_terms = asked["terms"].to_pylist()
        vocabulary = {t: i for i, t in enumerate(sorted({t for ts in own_terms for t in ts}))}
        counted = _counted(docs, id_col, text_col, vocabulary)
        n_docs, total = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        weights = np.zeros(len(vocabulary), dtype=np.int64)
        for term, df in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            weights[term] = weight(df, n_docs)
        numbered = np.array(sorted((i, vocabulary[t]) for i, ts in enumerate(own_terms) for t in ts), dtype=np.int64)
        found = _ranked(counted, asked["item"].combine_chunks(), numbered, weights, n_docs, total, item_type, top)
        out = found if out is None else out.unionByName(found)
    if out is None:
        kind = docs.schema[id_col].dataType.simpleString()
        out = docs.sparkSession.createDataFrame([], f"item {item_type}, id {kind}, score long")
    order = [F.desc("score"), F.asc_nulls_last("id")]
    salted = out.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    return best.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
#: DuckDB SQL for search over the tables documents and benchmark.
SQL = f"""
WITH docs AS (SELECT doc_id, {_TERMS} AS ts FROM documents WHERE text IS NOT NULL),
totals AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS total FROM docs WHERE len(ts) > 0),
counts AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS t FROM docs) GROUP BY ALL),
frequencies AS (SELECT t, count(*) AS df FROM counts GROUP BY t),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
scores AS (
    SELECT item_id, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
        * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // total)))) AS BIGINT) AS score
    FROM wanted JOIN counts USING (t) JOIN frequencies USING (t) CROSS JOIN totals GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""
