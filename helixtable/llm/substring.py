"""Removal of repeated word windows, with a count-min sketch before the exact count.

A window is WINDOW consecutive words of one document. Each window is represented by its anchor: the word 8-gram in it with the
smallest hash (the leftmost of equals). Equal windows have equal anchors at equal offsets, so a window is repeated only if
its anchor's 8-gram occurs at two anchor positions; neighbouring windows mostly share an anchor, which leaves about 7
positions for 100 windows.

1. Each partition sketches its anchors; the sketches are added up per range of counters. Counters are never too low.
2. Windows whose anchor may be repeated go to the exact count as runs: neighbouring windows with one anchor position. Runs
   with equal words (hashes of the first and last window, which cover them) are counted first; each different run then
   brings its windows once, weighted, and windows are counted by hashes of the anchor and of the whole. Nothing that
   repeats is lost.
3. Documents get their repeated windows back and drop the words under them. Runs are computed again for that instead of being kept with
   all their hashes, and texts are compressed on their way through the join: both save disk for some CPU time.

The merged sketch is two bit maps ("counted twice or more") of a fixed size, broadcast; with corpora beyond its width the
sketch lets more pass and the exact count does more of the work, with the same result.

Defined results: a null or blank text has no words; documents shorter than a window lose nothing; rows that are repeated
as a whole count as occurrences of their own; an empty table gives an empty table; further columns stay, and a column that has
the name of a result is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from xxhash import xxh64_digest

from helixtable.llm.common import fresh, slices, stash

WINDOW, GRAM = 35, 8
SPAN = WINDOW - GRAM + 1
ROWS, WIDTH_BITS, RANGE_BITS = 2, 27, 21
CHUNK_WORDS, CACHE_WORDS = 200_000, 100_000
BASE = 0x9E3779B97F4A7C15
SALTS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class _Words(dict):
    """Hash of a word, remembered for the first CACHE_WORDS words that a worker meets."""

    def __missing__(self, word: bytes) -> bytes:
        h = xxh64_digest(word)
        if len(self) < CACHE_WORDS:
            self[word] = h
        return h


_WORDS = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _join(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """Hashes of 2k words from hashes of k words."""
    return h[:-k] * np.uint64(pow(base, k, 1 << 64)) + h[k:]


def _hashes(words: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial hashes of all 8-grams and all windows."""
    h1 = words
    h2 = _join(h1, 1, base)
    h8 = _join(_join(h2, 2, base), 4, base)
    h32 = _join(_join(h8, 8, base), 16, base)
    n = len(words) - WINDOW + 1
    full = h32[:n] * np.uint64(pow(base, 3, 1 << 64)) + h2[32 : 32 + n] * np.uint64(base) + h1[34 : 34 + n]
    return _mix(h8), _mix(full)


def _chunks(texts: pa.Array) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    """Row numbers and words of the documents that have a window, about CHUNK_WORDS words at a time."""
    rows, docs, n = [], [], 0
    for i, t in enumerate(texts):
        t = t.as_py()
        ws = t.encode().split() if t else ()
        if len(ws) < WINDOW:
            continue
        rows.append(i)
        docs.append(ws)
        n += len(ws)
        if n >= CHUNK_WORDS:
            yield rows, docs
            rows, docs, n = [], [], 0
    if rows:
        yield rows, docs


class _Chunk:
    """Windows of some documents, joined end to end: starts of valid windows, their anchors, hashes of anchors."""

    def __init__(self, docs: list[list[bytes]]):
        self.sizes = np.array([len(d) for d in docs])
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.h = np.frombuffer(b"".join([_WORDS[w] for d in docs for w in d]), dtype=np.uint64)
        self.grams, self.windows = _hashes(self.h, BASE)
        valid = np.zeros(len(self.h) + 1, dtype=np.int8)
        valid[self.first[:-1]] += 1
        np.subtract.at(valid, self.first[1:] - WINDOW + 1, 1)
        self.at = np.flatnonzero(np.cumsum(valid)[: len(self.windows)])
        # the upper 32 bits of a gram's hash and its position: the least of them is the leftmost of the least hashes
        c = (self.grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(self.grams), dtype=np.uint64)
        for k in (1, 2, 4, 8):
            c = np.minimum(c[:-k], c[k:])
        c = np.minimum(c[: -(SPAN - 16)], c[SPAN - 16 :])
        self.anchor = (c[self.at] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _counters(grams: np.ndarray, row: int, width_bits: int) -> np.ndarray:
    return (grams * np.uint64(SALTS[row])) >> np.uint64(64 - width_bits)


def _sketch(batches: Iterator[pa.RecordBatch], width_bits: int) -> Iterator[pa.RecordBatch]:
    """One partition's sketch: for each range of counters, the low bits of those it hits, twice for two or more hits."""
    pieces: list[list[np.ndarray]] = [[] for _ in range(ROWS)]

    def table(rows: Iterator[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(list(rows), pa.schema([("r", pa.int32()), ("part", pa.int32()), ("hits", pa.binary())]))

    def packed() -> Iterator[dict]:
        for r in range(ROWS):
            if not pieces[r]:
                continue
            hit, n = np.unique(np.concatenate(pieces[r]), return_counts=True)
            hit = np.repeat(hit, np.minimum(n, 2))
            part = (hit >> np.uint64(RANGE_BITS)).astype(np.int64)
            low = (hit & np.uint64((1 << RANGE_BITS) - 1)).astype(np.uint32)
            cut = np.flatnonzero(np.diff(part)) + 1
            for p, x in zip(part[np.concatenate([[0], cut])], np.split(low, cut)):
                yield {"r": r, "part": int(p), "hits": x.tobytes()}
            pieces[r].clear()

    held = 0
    for b in batches:
        for _, docs in _chunks(b.column("text")):
            c = _Chunk(docs)
            grams = c.grams[np.unique(c.anchor)]
            for r in range(ROWS):
                pieces[r].append(_counters(grams, r, width_bits))
            held += len(grams)
            if held > 1_000_000:  # a long partition sends its sketch in instalments
                yield table(packed())
                held = 0
    yield table(packed())


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up sketches that come sorted by range; one bit for each counter of 2 or more."""
    key, total = None, np.zeros(1 << RANGE_BITS, dtype=np.uint8)

    def done() -> pa.RecordBatch:
        bits = zlib.compress(np.packbits(total >= 2).tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([bits], pa.binary())], names=["r", "part", "bits"])

    for b in batches:
        for r, p, hits in zip(b.column("r").to_pylist(), b.column("part").to_pylist(), b.column("hits")):
            if (r, p) != key:
                if key is not None:
                    yield done()
                key = (r, p)
                total[:] = 0
            hit, n = np.unique(np.frombuffer(hits.as_py(), dtype=np.uint32), return_counts=True)
            total[hit] = np.minimum(2, total[hit] + n)
    if key is not None:
        yield done()


def merged_sketch(docs: DataFrame, width_bits: int = WIDTH_BITS) -> np.ndarray:
    """Bit maps of counters that reached 2, one for each row of the sketch: ROWS * 2^width_bits bits whatever the corpus."""
    n = ROWS << (width_bits - RANGE_BITS)
    parts = docs.select("text").mapInArrow(lambda batches: _sketch(batches, width_bits), "r int, part int, hits binary")
    merged = parts.repartition(n, "r", "part").sortWithinPartitions("r", "part").mapInArrow(_merge, "r int, part int, bits binary")
    out = np.zeros((ROWS, 1 << (width_bits - 3)), dtype=np.uint8)
    step = 1 << (RANGE_BITS - 3)
    for row in merged.toLocalIterator():
        out[row.r, row.part * step : (row.part + 1) * step] = np.frombuffer(zlib.decompress(row.bits), dtype=np.uint8)
    return out


def candidate_runs(docs: DataFrame, shared: Broadcast, width_bits: int, hashes: bool) -> DataFrame:
    """Runs of windows whose anchor may be repeated.

    a, b: hashes of the first and the last window; n: windows less one. With hashes, then g: the anchor's hash, and w: the
    windows' hashes; else rid and at: the row (see row_id) and the place of its first window.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            rid = batch.column("rid").to_numpy(zero_copy_only=False)
            th = batch.column("th").to_numpy(zero_copy_only=False)
            for rows, docs in _chunks(batch.column("text")):
                c = _Chunk(docs)
                maybe = np.ones(len(c.at), dtype=bool)
                for r in range(ROWS):
                    k = _counters(c.grams[c.anchor], r, width_bits).astype(np.int64)
                    maybe &= (bits[r, k >> 3] >> (7 - (k & 7)).astype(np.uint8)) & 1 == 1
                at, anchor = c.at[maybe], c.anchor[maybe]
                if not len(at):
                    continue
                w = c.windows[at].view(np.int64)
                first = np.concatenate([[0], np.flatnonzero((np.diff(anchor) != 0) | (np.diff(at) != 1)) + 1])
                last = np.concatenate([first[1:], [len(at)]]) - 1
                cols = {"a": pa.array(w[first]), "b": pa.array(w[last]), "n": pa.array((last - first).astype(np.int32))}
                if hashes:
                    offsets = pa.array(np.concatenate([first, [len(at)]]).astype(np.int32))
                    cols |= {"g": pa.array(c.grams[anchor[first]].view(np.int64)), "w": pa.ListArray.from_arrays(offsets, pa.array(w))}
                else:
                    doc = np.searchsorted(c.first, at[first], side="right") - 1
                    row = np.array(rows)[doc]
                    cols |= {"rid": pa.array(rid[row]), "at": pa.array((th[row] << 32) | (at[first] - c.first[doc]))}
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return docs.select(*row_id(docs), "text").mapInArrow(part, "a long, b long, n int, " + ("g long, w array<long>" if hashes else "rid long, at long"))


def row_id(docs: DataFrame) -> list:
    """rid and th name a row: its identifier (its hash where that is no integer, the text's where it is null) and 31 bits of its text's hash."""
    h = F.xxhash64("text")
    name = F.col("doc_id").cast("long") if isinstance(docs.schema["doc_id"].dataType, IntegralType) else F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id"))
    return [F.coalesce(name, h).alias("rid"), F.shiftrightunsigned(h, 33).alias("th")]


def repeated_windows(docs: DataFrame, width_bits: int = WIDTH_BITS) -> DataFrame:
    """rid, th and spans (array of first window and bit mask of repeated windows from there) of rows with repeats."""
    sketch = docs.sparkSession.sparkContext.broadcast(merged_sketch(docs, width_bits))
    key = ["a", "b", "n"]
    kinds = candidate_runs(docs, sketch, width_bits, hashes=True).groupBy(*key).agg(F.count(F.lit(1)).alias("times"), F.first("g").alias("g"), F.first("w").alias("w"))
    kinds = stash(kinds)
    each = kinds.select(*key, "g", F.least("times", F.lit(2)).alias("times"), F.posexplode("w").alias("i", "w"))
    twice = each.groupBy("g", "w").agg(F.sum("times").alias("c")).where("c >= 2").select("g", "w")
    bit = F.expr("shiftleft(1L, i)")
    single = each.where("times = 1").join(twice, ["g", "w"], "left_semi").groupBy(*key).agg(F.bit_or(bit).alias("mask"))
    whole = kinds.where("times > 1").select(*key, (F.expr("shiftleft(1L, n + 1)") - 1).alias("mask"))
    runs = candidate_runs(docs, sketch, width_bits, hashes=False)
    masks = whole.unionByName(single)
    found = runs.select("rid", "at", *key).join(masks, key)
    span = F.struct(F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).alias("at"), "mask")
    return found.groupBy("rid", F.shiftright("at", 32).alias("th")).agg(F.collect_list(span).alias("spans"))


def covered_words(n: int, spans) -> np.ndarray:
    """Which of n words lie under a repeated window."""
    edge = np.zeros(n + 1, dtype=np.int32)
    at = np.array([s["at"] for s in spans], dtype=np.int64)
    mask = np.array([s["mask"] for s in spans], dtype=np.int64)
    for i in range(SPAN):
        starts = at[(mask >> i) & 1 == 1] + i
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def squeezed(df: DataFrame) -> DataFrame:
    """df with its text compressed, as the binary column text."""
    names = df.columns

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shrink = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            z = pa.array([shrink(t.as_py().encode()) if t.is_valid else None for t in b.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([z if c == "text" else b.column(c) for c in names], names=names)

    return df.mapInArrow(part, ", ".join(f"`{c}` {'binary' if c == 'text' else t}" for c, t in df.dtypes))


def strip_repeats(docs: DataFrame, width_bits: int = WIDTH_BITS) -> DataFrame:
    """docs with n_words, n_removed (longs) and kept_text (kept words joined by one space; empty for no words)."""
    new = ["n_words", "n_removed", "kept_text"]
    old = [c for c in docs.columns if c not in new]
    spans = repeated_windows(docs, width_bits)
    rid, th, at = (fresh(docs, f"{n}_of_row") for n in ("rid", "th", "spans"))
    keyed = docs.select(*old, *[c.alias(n) for c, n in zip(row_id(docs), (rid, th))])
    s = spans.select(F.col("rid").alias(rid), F.col("th").alias(th), F.col("spans").alias(at))
    joined = squeezed(keyed).join(s, [rid, th], "left").drop(rid, th)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for b in (x for batch in batches for x in slices(batch, "text")):
            texts = [expand(z.as_py()) if z.is_valid else None for z in b.column("text")]
            out: list[list] = [[], [], []]
            for text, found in zip(texts, b.column(at)):
                ws = text.split() if text else []
                kept = ws
                if found.is_valid:
                    gone = covered_words(len(ws), found.as_py())
                    kept = [w for w, g in zip(ws, gone.tolist()) if not g]
                out[0].append(len(ws))
                out[1].append(len(ws) - len(kept))
                out[2].append(b" ".join(kept).decode())
            plain = pa.array(texts, pa.binary()).cast(pa.string())
            cols = [plain if c == "text" else b.column(c) for c in old] + [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=old + new)

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in old)
    return joined.mapInArrow(part, f"{fields}, n_words long, n_removed long, kept_text string").select(*old, *new)
