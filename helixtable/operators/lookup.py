"""Places of wanted k-mers in sequences: a task hashes all k-mers of its sequences and makes rows of the wanted ones alone."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most distinct k-mers that are sent to the tasks (8 bytes each, and a table of 2**20 bytes); beyond, callers join all places.
SENT = 1 << 20
#: Letters that a task holds at a time, but for a longer sequence.
HELD = 1 << 21
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Wanted:
    """A set of 64-bit numbers, looked up in a small table of their upper mixed bits first."""

    def __init__(self, numbers: np.ndarray):
        self.sorted = np.unique(numbers.astype(np.uint64))
        self.table = np.zeros(1 << 20, dtype=bool)
        self.table[(self.sorted * SPREAD) >> np.uint64(44)] = True

    def places(self, numbers: np.ndarray) -> np.ndarray:
        """Where wanted numbers are."""
        at = np.flatnonzero(self.table[(numbers * SPREAD) >> np.uint64(44)])
        if not len(at):
            return at
        near = np.searchsorted(self.sorted, numbers[at])
        return at[self.sorted[np.minimum(near, len(self.sorted) - 1)] == numbers[at]]


def held(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of the batches with their texts, of about HELD letters each; null is empty."""
    for b in batches:
        texts, first, n = [], 0, 0
        for i, t in enumerate(b.column(column)):
            texts.append(t.as_py() or "")
            n += len(texts[-1])
            if n >= HELD or i + 1 == b.num_rows:
                yield b.slice(first, i + 1 - first), texts
                texts, first, n = [], i + 1, 0


def hashes(letters: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k letters from each place on."""
    h = np.zeros(max(0, len(letters) - k + 1), dtype=np.uint64)
    for j in range(k):
        h = h * SPREAD + letters[j : j + len(h)]
    return h ^ (h >> np.uint64(32))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def wanted_kmers(sequences: DataFrame, k: int, asked: DataFrame, id_col: str = "seq_id", sequence: str = "sequence") -> DataFrame | None:
    """id, kmer and its place (from 1) for those k-mers of each sequence that asked(kmer) has; a few others whose hash is the same may be among them.

    None where asked has more than SENT k-mers. Sequences are read whole: cut chromosomes into overlapping chunks first.
    """
    if asked.count() > SENT:
        return None
    texts = asked.toArrow()["kmer"].to_pylist()
    wanted = sequences.sparkSession.sparkContext.broadcast(Wanted(np.array([hashes(code_points(t), k)[0] for t in texts if len(t) == k], dtype=np.uint64)))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in held(batches, "text"):
            joined = "".join(texts)
            ends = np.cumsum([len(t) for t in texts])
            at = wanted.value.places(hashes(code_points(joined), k))
            row = np.searchsorted(ends, at, side="right")
            inside = at + k <= ends[row] if len(at) else np.zeros(0, dtype=bool)
            at, row = at[inside], row[inside]
            starts = ends - np.array([len(t) for t in texts])
            found = [joined[i : i + k] for i in at.tolist()]
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(row)), pa.array(found, pa.string()), pa.array((at - starts[row] + 1).astype(np.int32))], names=["id", "kmer", "pos"])

    given = sequences.select(F.col(id_col).alias("id"), F.col(sequence).alias("text"))
    found = given.mapInArrow(part, f"id {given.schema['id'].dataType.simpleString()}, kmer string, pos int")
    return found.withColumnRenamed("id", id_col)
