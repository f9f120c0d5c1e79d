"""Exact token counts at every prefix of a text, by dynamic programming over a sentencepiece BPE vocabulary.

The last token of a prefix's encoding is the one vocabulary piece t that ends there, stands for itself when encoded
alone, and is not merged differently next to the last token of the rest: tokens(p) = tokens(p - len(t)) + 1. Whether
two neighbours stay apart is found by merging their characters once and is remembered.

No piece has a space mark after another character, so texts fall into words (a run of space marks and what follows)
that are encoded independently; the table of a word's prefixes is remembered as differences, and a document's table is
their running sum. Vocabularies for which this does not hold, or that normalise texts, are refused.

Defined results: a null text is an empty one, with an empty table; characters outside the vocabulary count their bytes;
texts are taken whole; an empty table gives an empty table; of the other columns, prefix_table() keeps those asked for,
and prefix_counts replaces a column of its name.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from operator import sub

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtable.llm.common import fresh

MARK = "▁"
CACHE_WORDS, CACHE_PAIRS, CHUNK_CHARS = 800_000, 800_000, 2_000_000


class PrefixCounter:
    """Prefix token counts under one sentencepiece BPE model, given as the bytes of its file."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        plain = [i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        if any(MARK in p.lstrip(MARK) for p in self.score) or sp.decode(sp.encode(" ﬁ a  b\n ")) != " ﬁ a  b\n ":
            raise ValueError("this vocabulary joins words or normalises texts")
        alone = "" if any("\n" in p for p in self.score) else "\n"
        self.split = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|{alone}" if alone else "")).findall
        self.words: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.splits: dict[str, tuple[str, str]] = {}
        self.pieces = ahocorasick.Automaton()
        for p in filter(self.itself, self.score):
            self.pieces.add_word(p, (p, len(p)))
        self.pieces.make_automaton()

    def merge(self, text: str) -> list[str]:
        """Pieces after merging neighbours, best score first and leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def split_of(self, t: str) -> tuple[str, str] | None:
        """The two parts that the last merge of a piece joins; None for one character."""
        known = self.splits.get(t)
        if known is None and len(t) > 1:
            parts = list(t)
            while len(parts) > 2:
                at = max(range(len(parts) - 1), key=lambda i: (self.score.get(parts[i] + parts[i + 1], -math.inf), -i))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known = self.splits[t] = tuple(parts)
        return known

    def apart(self, a: str, b: str) -> bool:
        """Whether two pieces stay apart when their characters are merged together.

        Their own merges are undone, latest first; at each stage the two parts that touch must not make a piece that would have
        been merged before the merge that was just undone (from the left, ties go to the left). Pieces of space marks alone have equal
        scores and are merged out instead.
        """
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._apart(a, b) if a[0] != MARK or a[-1] != MARK else self.merge(a + b) == [a, b]
        return known

    def _apart(self, a: str, b: str) -> bool:
        score = self.score
        limit, right = -math.inf, False  # what touches merges first if its score is above this; also at it, left of the merge undone
        while True:
            joined = score.get(a + b)
            if joined is not None and (joined > limit or (right and joined == limit)):
                return False
            sa, sb = (score.get(a, math.inf) if len(a) > 1 else math.inf), (score.get(b, math.inf) if len(b) > 1 else math.inf)
            if sa == sb == math.inf:
                return True
            if sa < sb:  # the left piece was finished last
                limit, a, right = sa, self.split_of(a)[1], False
            else:
                limit, b, right = sb, self.split_of(b)[0], True

    def itself(self, t: str) -> bool:
        """Whether a piece is its own encoding."""
        return len(t) == 1 or self.merge(t) == [t]

    def word(self, text: str) -> list[int]:
        """Token counts of the prefixes of one word, from length 0 on.

        The automaton gives the pieces that end at each place; where none fits, the character itself is the last token.
        """
        n = len(text)
        counts, last = [0] * (n + 1), [""] * (n + 1)
        pairs = self.pairs

        def alone(p: int) -> None:
            last[p] = text[p - 1]
            counts[p] = counts[p - 1] + (1 if last[p] in self.score else len(last[p].encode()))

        ready = 1
        for at, (t, size) in self.pieces.iter(text):
            end = at + 1
            if last[end]:
                continue
            while ready < end:
                if not last[ready]:
                    alone(ready)
                ready += 1
            start = end - size
            if start:
                fits = pairs.get((last[start], t))
                if fits is None:
                    fits = self.apart(last[start], t)
                if not fits:
                    continue
            last[end] = t
            counts[end] = counts[start] + 1
        while ready <= n:
            if not last[ready]:
                alone(ready)
            ready += 1
        return counts

    def steps(self, word: str) -> bytes:
        known = self.words.get(word)
        if known is None:
            counts = self.word(word)
            known = array("h", map(sub, counts[1:], counts)).tobytes()
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            if len(word) <= 64:
                self.words[word] = known
        return known

    def counts(self, text: str) -> np.ndarray:
        """counts[i]: tokens of the first i + 1 characters."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        known, steps = self.words, self.steps
        parts = [known.get(w) or steps(w) for w in self.split(MARK + text.replace(" ", MARK))]
        return np.cumsum(np.frombuffer(b"".join(parts), dtype=np.int16), dtype=np.int32)[1:]


_COUNTERS: dict[int, PrefixCounter] = {}


def prefix_table(docs: DataFrame, model_file: str, keep: list[str]) -> DataFrame:
    """The columns in keep and prefix_counts (array<int>): at i, the tokens of the text's first i characters, from 1 on."""
    keep, own = [c for c in keep if c != "prefix_counts"], fresh(docs, "text_of_row")
    with open(model_file, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: below 10 MB whatever the corpus

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = model.value
        counter = _COUNTERS.setdefault(hash(raw), None) or PrefixCounter(raw)
        _COUNTERS[hash(raw)] = counter
        for b in batches:
            tables, held, first = [], 0, 0
            texts = b.column(own)
            for i in range(b.num_rows):
                tables.append(counter.counts(texts[i].as_py() or ""))
                held += len(tables[-1])
                if held >= CHUNK_CHARS or i == b.num_rows - 1:
                    offsets = np.concatenate([[0], np.cumsum([len(t) for t in tables])]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(tables)))
                    yield pa.RecordBatch.from_arrays([*(b.column(c).slice(first, len(tables)) for c in keep), lists], names=[*keep, "prefix_counts"])
                    tables, held, first = [], 0, i + 1

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col("text").alias(own)).mapInArrow(part, f"{fields}, prefix_counts array<int>")


def tokens_of_prefix(counts: Column, chars: Column | int) -> Column:
    """Tokens of the first chars characters (all of them, if the text is shorter)."""
    n = F.least(F.lit(chars) if isinstance(chars, int) else chars, F.size(counts))
    return F.when(n > 0, F.element_at(counts, n)).otherwise(0)


def longest_prefix(counts: Column, budget: Column | int) -> Column:
    """Characters of the longest prefix that takes at most budget tokens."""
    return F.coalesce(F.array_max(F.transform(counts, lambda c, i: F.when(c <= budget, i + 1))), F.lit(0))
