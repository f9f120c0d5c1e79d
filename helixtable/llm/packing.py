"""Best-fit packing of tokenised documents into sequences by a grouping genetic algorithm on islands.

Documents longer than a sequence are cut into full pieces, the first one shorter; full pieces are sequences of their own. The other pieces are
dealt by hash to cells of about CELL pieces. Several islands evolve packings of each cell: a crossover puts whole
well-filled sequences of one parent into the other, drops the sequences there that hold any of their pieces, and places
the displaced pieces again by best fit, longest first. Between epochs each island sends its best packing to the next
island of its cell. Pieces in sequences that stay poorly filled are pooled over all cells and packed once more.

An island is a row and migration is a join, so a lost executor costs the islands of its partitions and no more.

Defined results: a null text is an empty one and its document is the closing id alone; equal rows are packed as
documents of their own; an empty table gives an empty table; further columns are left out unless carried.
"""

from __future__ import annotations

import base64
import random
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtable.llm.common import fresh, settled

ROOM, END_ID = 1024, 2
CELL, ISLANDS, EPOCHS, GENERATIONS, PACKINGS = 8192, 2, 2, 6, 4
POOR, WORK = 0.97, 400

#: Fixed value: how the byte-level vocabulary cuts a text into words.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts of these characters alone are cut alike by both libraries; others, and those with the special string, go to tokenizers.
UNUSUAL = re.compile(r"[^\t\n\r -~À-ÖØ-öø-ɏ]|<\|endoftext\|>").search


class Encoder:
    """Token ids of texts, as tokenizers gives them for a byte-level vocabulary, as bytes (little-endian, 32 bits each).

    With the same vocabulary as ranks, texts of usual characters are encoded by tiktoken, to the same ids in a quarter of the time.
    """

    def __init__(self, vocabulary: str, ranks: bytes | None = None):
        from tokenizers import Tokenizer

        self.library, self.fast = Tokenizer.from_str(vocabulary), None
        if ranks:
            import tiktoken

            table = {base64.b64decode(t): int(n) for t, n in map(bytes.split, ranks.splitlines())}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> bytes:
        if self.fast and not UNUSUAL(text):
            return array("I", self.fast(text)).tobytes()
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()


_ENCODERS: dict[int, Encoder] = {}


def pieces(docs: DataFrame, vocabulary_file: str, keep: list[str], ranks_file: str | None = None, with_ids: bool = False) -> DataFrame:
    """The columns in keep and piece, start, length, ids_crc32 (and ids, if asked for) for each piece of each document.

    vocabulary_file: for tokenizers. ranks_file: the same vocabulary for tiktoken, for speed.
    """
    with open(vocabulary_file, encoding="utf-8") as v, open(ranks_file or vocabulary_file, "rb") as r:
        shared = docs.sparkSession.sparkContext.broadcast((v.read(), r.read() if ranks_file else None))  # below 10 MB whatever the corpus
    own = ["piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    keep, name = [c for c in keep if c not in own], fresh(docs, "text_of_row")
    end = np.array([END_ID], dtype="<u4").tobytes()

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        raw = shared.value
        encoder = _ENCODERS.get(hash(raw)) or _ENCODERS.setdefault(hash(raw), Encoder(*raw))
        for b in batches:
            row, out = [], [[] for _ in own]
            for i, text in enumerate(b.column(name)):
                ids = encoder.encode(text.as_py() or "") + end
                n, at, k = len(ids) // 4, 0, 0
                while at < n:
                    size = n if n <= ROOM else (n - at) % ROOM or ROOM
                    cut = ids[4 * at : 4 * (at + size)]
                    row.append(i)
                    for o, v in zip(out, (k, at, size, zlib.crc32(cut), cut)):
                        o.append(v)
                    at, k = at + size, k + 1
            if with_ids:
                out[-1] = [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in out[-1]]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            cols = [pa.array(v, t) for v, t in zip(out, types)]
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(row, pa.int64())) for c in keep), *cols], names=[*keep, *own])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col("text").alias(name)).mapInArrow(part, f"{fields}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


class Packing:
    """Sequences as lists of items, with their free room; rooms are found by a bit mask, so a best fit takes constant time."""

    def __init__(self, sizes: list[int], bins: list[list[int]] | None = None):
        self.sizes, self.bins = sizes, bins or []
        self.room = [ROOM - sum(sizes[i] for i in b) for b in self.bins]

    def place(self, items: list[int]) -> Packing:
        """Puts items, in their order, where the least room stays."""
        at: dict[int, list[int]] = {}
        for k, r in enumerate(self.room):
            at.setdefault(r, []).append(k)
        mask = 0
        for r in at:
            mask |= 1 << r
        for i in items:
            s = self.sizes[i]
            fits = mask >> s
            if fits:
                r = s + (fits & -fits).bit_length() - 1
                k = at[r].pop()
                if not at[r]:
                    mask ^= 1 << r
                self.bins[k].append(i)
            else:
                k, r = len(self.bins), ROOM
                self.bins.append([i])
                self.room.append(ROOM)
            r -= s
            self.room[k] = r
            at.setdefault(r, []).append(k)
            mask |= 1 << r
        return self

    def fitness(self) -> tuple[int, int]:
        """Fewer sequences, then fuller ones."""
        return -len(self.bins), sum((ROOM - r) ** 2 for r in self.room)

    def code(self) -> bytes:
        out = np.zeros(len(self.sizes), dtype=np.int32)
        for k, b in enumerate(self.bins):
            out[b] = k
        return out.tobytes()

    @classmethod
    def decode(cls, sizes: list[int], code: bytes) -> Packing:
        where = np.frombuffer(code, dtype=np.int32).tolist()
        bins: list[list[int]] = [[] for _ in range(max(where, default=-1) + 1)]
        for i, k in enumerate(where):
            bins[k].append(i)
        return cls(sizes, bins)


def longest_first(sizes: list[int], items: list[int], rng: random.Random, noise: float = 0.0) -> list[int]:
    return sorted(items, key=lambda i: -sizes[i] * (1 + noise * rng.random()))


def exchange(sizes: list[int], bins: list[list[int]], loose: list[int], rng: random.Random) -> list[int]:
    """Puts loose items for one or two smaller ones into sequences, so that those get fuller; what came out is loose then.

    Sequences become fuller and loose items smaller with each exchange, which are easier to place.
    """
    loose = sorted(loose, key=lambda i: sizes[i])
    keys = [sizes[i] for i in loose]
    for b in rng.sample(bins, len(bins)):
        room = ROOM - sum(sizes[i] for i in b)
        if not room or not loose:
            continue
        few = b if len(b) <= 6 else rng.sample(b, 6)
        best = None  # gain, items out, places of loose items in
        for out in [*((i,) for i in few), *combinations(few, 2)]:
            s = sum(sizes[i] for i in out)
            k = bisect_right(keys, s + room) - 1  # the largest loose item that fits
            if k >= 0 and keys[k] > s and (best is None or keys[k] - s > best[0]):
                best = keys[k] - s, out, (k,)
            if best is not None and best[0] == room:
                break
            for _ in range(2):  # two loose items: one by chance, the other as large as fits
                j = rng.randrange(len(keys))
                k = bisect_right(keys, s + room - keys[j]) - 1
                k -= k == j
                if k >= 0 and keys[j] + keys[k] > s and (best is None or keys[j] + keys[k] - s > best[0]):
                    best = keys[j] + keys[k] - s, out, (j, k)
        if best:
            _, out, places = best
            b[:] = [i for i in b if i not in out] + [loose[k] for k in places]
            for k in sorted(places, reverse=True):
                del loose[k], keys[k]
            for i in out:
                k = bisect_right(keys, sizes[i])
                loose.insert(k, i)
                keys.insert(k, sizes[i])
    return loose


def crossover(into: Packing, giver: Packing, rng: random.Random) -> Packing:
    """into with some of the giver's well-filled sequences; a few of its worst sequences are opened as well.

    Displaced items are exchanged against smaller ones of the other poorly filled sequences first, and then placed.
    """
    full = [b for b, r in zip(giver.bins, giver.room) if r <= ROOM // 64]
    injected = rng.sample(full, (len(full) + 1) // 2)
    taken = bytearray(len(into.sizes))
    for b in injected:
        for i in b:
            taken[i] = 1
    worst = set(sorted(range(len(into.bins)), key=lambda k: -into.room[k])[: 2 + len(into.bins) // 50])
    kept, displaced = [list(b) for b in injected], []
    for k, b in enumerate(into.bins):
        if k in worst or any(taken[i] for i in b):
            displaced += [i for i in b if not taken[i]]
        else:
            kept.append(list(b))
    open_bins = [b for b in kept[len(injected) :] if ROOM - sum(into.sizes[i] for i in b) > 0]
    displaced = exchange(into.sizes, open_bins if len(open_bins) <= WORK else rng.sample(open_bins, WORK), displaced, rng)
    return Packing(into.sizes, kept).place(longest_first(into.sizes, displaced, rng, 0.02))


def least_sequences(sizes: list[int]) -> int:
    """Martello and Toth's bound L2: no packing takes fewer sequences.

    For each limit, items that leave less room than the limit stand alone; those over half a sequence stand apart, and what of the
    smaller ones down to the limit exceeds the room beside them needs further sequences.
    """
    n = np.bincount(sizes, minlength=ROOM + 1)[: ROOM + 1]
    count, total = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * np.arange(ROOM + 1))])
    limit = np.arange(ROOM // 2 + 1)
    half, top = ROOM // 2 + 1, ROOM - limit + 1  # items over half: from `half` on; those that stand alone: from `top` on
    alone, apart = count[-1] - count[top], count[top] - count[half]
    over = (total[half] - total[limit]) - (apart * ROOM - (total[top] - total[half]))
    return int((alone + apart + np.maximum(0, -(-over // ROOM))).max())


def evolve(sizes: list[int], population: list[Packing], rng: random.Random) -> list[Packing]:
    """Up to PACKINGS packings, the best one first, after at most GENERATIONS generations, more of them for few items; stops at a proven least number of sequences."""
    everything, least = list(range(len(sizes))), least_sequences(sizes)
    while len(population) < PACKINGS and not any(len(p.bins) <= least for p in population):
        population.append(Packing(sizes).place(longest_first(sizes, everything, rng, 0.1 * len(population) / PACKINGS)))
    for _ in range(max(GENERATIONS, min(40 * GENERATIONS, GENERATIONS * CELL // max(1, 4 * len(sizes))))):
        population = sorted(population, key=Packing.fitness, reverse=True)
        if len(population) < 2 or len(population[0].bins) <= least:
            break
        a, b = rng.sample(population[:3], 2)
        population = [*population[: PACKINGS - 2], crossover(a, b, rng), crossover(b, a, rng)]
    return sorted(population, key=Packing.fitness, reverse=True)[:PACKINGS]


def _epoch(epoch: int):
    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for cell, island, sizes, codes in zip(b["cell"], b["island"], b["sizes"], b["codes"]):
                sizes = [int(s) for s in sizes]
                rng = random.Random(f"{cell}/{island}/{epoch}")
                population = [Packing.decode(sizes, c) for c in (codes if codes is not None else [])]
                best = evolve(sizes, population, rng)
                out.append((cell, island, sizes, [p.code() for p in best], len(best[0].bins), best[0].fitness()[1]))
            yield pd.DataFrame(out, columns=["cell", "island", "sizes", "codes", "n", "fill"])

    return part


def pack_cells(items: DataFrame, cells: int) -> DataFrame:
    """id, cell, bin, room (left in its sequence) and offset for items(id long, length long)."""
    dealt = items.select("id", "length", F.pmod(F.xxhash64("id"), F.lit(cells)).alias("cell"))
    rows = settled(dealt.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("id", F.col("length").cast("int").alias("size")))).alias("items")))
    islands = rows.select("cell", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.col("items.size").alias("sizes"), F.lit(None).cast("array<binary>").alias("codes"))
    for epoch in range(EPOCHS):
        if epoch:  # the neighbour's best packing takes the place of the worst
            elite = islands.select("cell", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.element_at("codes", 1).alias("elite"))
            islands = islands.join(elite, ["cell", "island"]).withColumn("codes", F.concat(F.array("elite"), F.slice("codes", 1, PACKINGS - 1)))
        parts = max(1, min(cells * ISLANDS, 4096))
        spread = islands.select("cell", "island", "sizes", "codes").repartition(parts, "cell", "island")
        islands = settled(spread.mapInPandas(_epoch(epoch), "cell long, island int, sizes array<int>, codes array<binary>, n long, fill long"))
    best = islands.groupBy("cell").agg(F.max_by(F.element_at("codes", 1), F.struct(-F.col("n"), "fill", -F.col("island"))).alias("code"))

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for cell, code, ids, sizes in zip(b["cell"], b["code"], b["ids"], b["sizes"]):
                p = Packing.decode([int(s) for s in sizes], code)
                out = []
                for k, members in enumerate(p.bins):
                    at = 0
                    for i in members:
                        out.append((ids[i], cell, k, p.room[k], at))
                        at += p.sizes[i]
                yield pd.DataFrame(out, columns=["id", "cell", "bin", "room", "offset"])

    full = rows.select("cell", F.col("items.id").alias("ids"), F.col("items.size").alias("sizes")).join(best, "cell")
    return full.mapInPandas(places, "id long, cell long, bin long, room long, offset long")


def place(items: DataFrame) -> DataFrame:
    """id, sequence_id and offset for items(id long, unique; length long, below ROOM)."""
    n = items.count()
    cells = max(1, -(-n // CELL))
    first = settled(pack_cells(items, cells))
    name = lambda base: (F.col("cell") + F.lit(base)) * F.lit(2 * CELL * 4) + F.col("bin")
    if cells == 1:
        return first.select("id", name(0).alias("sequence_id"), "offset")
    poor = F.col("room") > (1 - POOR) * ROOM
    again = settled(items.join(first.where(poor).select("id"), "id"))
    more = max(1, -(-again.count() // CELL))
    second = pack_cells(again, more)
    return first.where(~poor).select("id", name(0).alias("sequence_id"), "offset").union(second.select("id", name(cells).alias("sequence_id"), "offset"))


def pack(docs: DataFrame, vocabulary_file: str, carry: list[str], ranks_file: str | None = None) -> DataFrame:
    """The carried columns and piece, start, length, ids_crc32, sequence_id and offset for each piece."""
    carry = [c for c in carry if c not in ("sequence_id", "offset")]
    rows = settled(pieces(docs, vocabulary_file, carry, ranks_file))
    carry, own = rows.columns, fresh(rows, "item")
    rows = rows.withColumn(own, F.monotonically_increasing_id())  # stable over a checkpoint
    items = rows.where(F.col("length") < ROOM)
    full = rows.where(F.col("length") == ROOM).select(*carry, (-1 - F.col(own)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    placed = place(items.select(F.col(own).alias("id"), "length")).withColumnRenamed("id", own)
    return full.unionByName(items.join(placed, own).select(*carry, "sequence_id", "offset"))
