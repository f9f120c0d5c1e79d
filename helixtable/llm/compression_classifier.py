"""Quality classifier by compression: zstandard dictionaries from good and from bad labelled text.

A text is compressed in chunks with either dictionary. The difference of the compressed sizes over the larger one says which
dictionary knows the text better; a logistic curve, fitted on labelled rows that went into neither dictionary, makes it a
probability, with classes weighted as they occur among all labels in use.

Only the text is an input. Identifiers that have both labels are not used; of several texts of one identifier, the least is. The fit sees at most per_class rows of each label, with texts of at most sample_bytes bytes: 2 x 1500 x 32 KB
at most on the driver, whatever the corpus. The model is two dictionaries of at most DICTIONARY bytes and two numbers.

Defined results: null and blank texts score what a size difference of zero scores; texts are scored whole; rows with a null
doc_id are never held out; with one class or no labels the score is that class's share (0.5 without labels); equal
texts score equally; an empty table gives an empty table; results replace columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtable.llm.common import fresh, slices

DICTIONARY, LEVEL, CHUNK = 112_640, 3, 1024


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    trained: bool
    slope: float
    offset: float

    def compressor(self, data: bytes) -> zstandard.ZstdCompressor:
        d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT if self.trained else zstandard.DICT_TYPE_RAWCONTENT)
        if self.trained:
            d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)

    def differences(self, texts) -> np.ndarray:
        """Over 0 where the good dictionary compresses better."""
        if not self.good or not self.bad:
            return np.zeros(len(texts))
        good, bad = self.compressor(self.good).compress, self.compressor(self.bad).compress
        out = []
        for t in texts:
            raw = (t or "").encode()
            parts = [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)]
            a, b = sum(len(good(p)) for p in parts), sum(len(bad(p)) for p in parts)
            out.append((b - a) / max(a, b, 1))
        return np.array(out)

    def scores(self, texts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.differences(texts) + self.offset, -500, 500)))


def _dictionary(texts: list[str]) -> tuple[bytes, bool]:
    """A trained dictionary, or the texts themselves where they are too few to train one."""
    parts = []
    for t in texts:
        raw = t.encode()
        starts = range(0, max(len(raw), 1), 2000)
        parts += [raw[i : i + 2000] for i in list(starts)[:: max(1, len(starts) // 4)]]
    try:
        return zstandard.train_dictionary(DICTIONARY, parts).as_bytes(), True
    except zstandard.ZstdError:
        return b"\n".join(parts)[-DICTIONARY:], False


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression on one input by Newton's method, with a light ridge on the scaled slope."""
    scale = x.std() or 1.0
    z = np.stack([x / scale, np.ones_like(x)], axis=1)
    beta, ridge = np.zeros(2), np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (w * p * (1 - p) + 1e-9)[:, None]).T @ z + ridge, z.T @ (w * (y - p)) - ridge @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500, sample_bytes: int = 32_768) -> Model:
    """A model from labels(doc_id, quality) that are not held out and the texts of docs(doc_id, text)."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most").select("doc_id", "quality")
    n = {r.quality: r["count"] for r in usable.groupBy("quality").count().collect()}
    first = lambda q: usable.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    picks = F.broadcast(first(0).union(first(1)))  # 2 * per_class pairs of numbers
    texts = docs.select("doc_id", "text").where(F.octet_length("text") <= sample_bytes).join(picks, "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text")).collect()
    by = {q: [r.text for r in sorted(texts, key=lambda r: (r.doc_id, r.text)) if r.quality == q] for q in (0, 1)}
    if not by[0] or not by[1]:
        share = (n.get(1, 0) + 0.0) / (n.get(0, 0) + n.get(1, 0)) if n else 0.5
        return Model(b"", b"", False, 0.0, float(np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -20, 20)))
    fitted = {q: by[q][::3] if len(by[q]) > 2 else by[q] for q in by}
    rest = {q: [t for i, t in enumerate(by[q]) if i % 3] if len(by[q]) > 2 else by[q] for q in by}
    (bad, a), (good, b) = _dictionary(rest[0]), _dictionary(rest[1])
    if a != b:  # both of a kind, so that sizes compare
        bad, good = (b"\n".join(t.encode() for t in rest[q])[-DICTIONARY:] for q in (0, 1))
    model = Model(good, bad, a and b, 1.0, 0.0)
    x = np.concatenate([model.differences(fitted[q]) for q in (0, 1)])
    y = np.repeat([0.0, 1.0], [len(fitted[0]), len(fitted[1])])
    w = np.repeat([n[q] / sum(n.values()) / len(fitted[q]) for q in (0, 1)], [len(fitted[0]), len(fitted[1])]) * len(x)
    return Model(good, bad, a and b, *logistic(x, y, w))


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns in keep and score."""
    keep = [c for c in keep if c != "score"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = fresh(docs, "text_of_row")

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = np.concatenate([np.empty(0), *[shared.value.scores(x.column(own).to_pylist()) for x in slices(b, own)]])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(scores, pa.float64())], names=[*keep, "score"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col("text").alias(own)).mapInArrow(part, f"{fields}, score double")


def classify(docs: DataFrame, labels: DataFrame, keep: list[str], threshold: float = 0.7) -> DataFrame:
    """The columns in keep, held_out, score and predicted."""
    keep = [c for c in keep if c not in ("held_out", "score", "predicted")]
    out = score(docs, fit(docs, labels), list(dict.fromkeys([*keep, "doc_id"])))
    return out.select(*keep, held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
