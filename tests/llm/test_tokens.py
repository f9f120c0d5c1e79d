"""Prefix token counts and packing against the libraries, and packing against its bounds."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from helixtable.llm import packing, token_counts

MODEL, BYTES, RANKS = (public_tokenizers.path(x) for x in ("piece_bpe_32k.model", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(open(MODEL, "rb").read())


def odd_texts():
    rng = random.Random(3)
    alphabet = "abcetrins  \n\t\r;{}▁éß漢😀ﬁ.,<>/s0x1"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(300)]
    return texts + ["", " ", "   ", " " * 100, "\n\n\n", "<s> </s> <unk> <0x0A>", "a" * 300, "=" * 130, "the quick brown fox's", "\x00\x1c\x85  x", "  a   b    c"]


def test_every_prefix(counter, library):
    for t in odd_texts():
        got = counter.counts(t)
        assert got.tolist() == [len(library.encode(t[: i + 1])) for i in range(len(t))], repr(t)


def test_pairs_stay_apart_as_merging_says(counter):
    rng = random.Random(6)
    own = [p for p in counter.score if counter.itself(p)]
    some = [p for p in own if len(p) <= 3] + rng.sample(own, 3000)
    for _ in range(60_000):
        a, b = rng.choice(some), rng.choice(some)
        if "▁" not in b:
            assert counter.apart(a, b) == (counter.merge(a + b) == [a, b]), (a, b)


def test_whole_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = token_counts.prefix_table(docs, MODEL, ["doc_id"]).select("doc_id", F.element_at("prefix_counts", -1).alias("n"), F.size("prefix_counts").alias("chars"))
    want = {r.doc_id: (len(library.encode(r.text)), len(r.text)) for r in docs.collect()}
    assert {r.doc_id: (r.n, r.chars) for r in got.collect()} == want


def test_budget_questions(odd, library):
    table = token_counts.prefix_table(odd, MODEL, ["doc_id", "text"])
    rows = table.select("text", token_counts.tokens_of_prefix(F.col("prefix_counts"), 5).alias("five"), token_counts.longest_prefix(F.col("prefix_counts"), 3).alias("fit")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        t = r.text or ""
        assert r.five == len(library.encode(t[:5]))
        assert r.fit == max(i for i in range(len(t) + 1) if len(library.encode(t[:i])) <= 3)


def test_other_vocabularies_are_refused():
    with pytest.raises(Exception):
        token_counts.PrefixCounter(b"")


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTES)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [2]


def check(rows, docs, encode):
    want = Counter()
    for r in docs:
        ids = encode(r.text)
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r.doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 1024
    return len(by)


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_packing(which, request, encode):
    df = request.getfixturevalue(which)
    rows = packing.pack(df, BYTES, ["doc_id"], RANKS).collect()
    assert {(r.doc_id, r.ids_crc32) for r in rows} == {(r.doc_id, r.ids_crc32) for r in packing.pieces(df, BYTES, ["doc_id"]).collect()}
    used = check(rows, df.collect(), encode)
    assert used <= -(-sum(r.length for r in rows) // 1024) + 2


def test_many_cells(spark):
    items = spark.range(9000).select("id", (1 + F.pmod(F.xxhash64("id"), F.lit(1023))).alias("length")).repartition(5).checkpoint() if spark.sparkContext.getCheckpointDir() else spark.range(9000).select("id", (1 + F.pmod(F.xxhash64("id"), F.lit(1023))).alias("length"))
    rows = packing.place(items).join(items, "id").collect()
    assert len(rows) == 9000
    load, ends = Counter(), defaultdict(list)
    for r in rows:
        load[r.sequence_id] += r.length
        ends[r.sequence_id].append((r.offset, r.length))
    assert max(load.values()) <= 1024
    assert all(sum(n for _, n in v[:k]) == o for v in map(sorted, ends.values()) for k, (o, _) in enumerate(v))
    assert len(load) <= 1.01 * sum(load.values()) / 1024


def test_unusual_texts(encode):
    texts = odd_texts() + ["it's we'll 'tis ''s", "x<|endoftext|>y", "a  b \n c\n", "É×ß ÷ 12³ Ω", "tab\tand  two", " ' s", " x"]
    for e in (packing.Encoder(open(BYTES, encoding="utf-8").read()), packing.Encoder(open(BYTES, encoding="utf-8").read(), open(RANKS, "rb").read())):
        assert [np.frombuffer(e.encode(t), dtype="<u4").tolist() + [2] for t in texts] == [encode(t) for t in texts]


def test_both_libraries_agree(spark, encode):
    e = packing.Encoder(open(BYTES, encoding="utf-8").read(), open(RANKS, "rb").read())
    usual = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rng = random.Random(7)
    usual += ["".join(chr(rng.choice([*range(32, 127), 9, 10, 13, *range(0xC0, 0x250)])) for _ in range(80)) for _ in range(2000)]
    assert sum(not packing.UNUSUAL(t) for t in usual) > 2000
    for t in usual:
        assert np.frombuffer(e.encode(t), dtype="<u4").tolist() + [2] == encode(t), repr(t)


def test_best_fit_and_crossover():
    rng = random.Random(4)
    sizes = [rng.randrange(1, 1024) for _ in range(400)]
    a, b = (packing.Packing(sizes).place(packing.longest_first(sizes, list(range(400)), rng, x)) for x in (0.0, 0.3))
    child = packing.crossover(a, b, rng)
    for p in (a, b, child, packing.Packing.decode(sizes, child.code())):
        assert sorted(i for x in p.bins for i in x) == list(range(400))
        assert [1024 - sum(sizes[i] for i in x) for x in p.bins] == p.room and min(p.room) >= 0
    best = packing.evolve(sizes, [], random.Random(5))
    assert best[0].fitness() >= a.fitness() or len(best[0].bins) <= len(a.bins)


def test_evolution_beats_best_fit():
    """Triples that fill sequences exactly, which best fit alone does not find; and the bound never exceeds a packing."""
    rng, sizes = random.Random(8), []
    for _ in range(120):
        a, b = rng.randrange(260, 420), rng.randrange(260, 420)
        sizes += [a, b, 1024 - a - b]
    plain = packing.Packing(sizes).place(packing.longest_first(sizes, list(range(len(sizes))), rng))
    best = packing.evolve(sizes, [], random.Random(9))
    for seed in range(3):  # more epochs, with migration of the best
        best = packing.evolve(sizes, best[:1] + best[:2], random.Random(seed))
    assert packing.least_sequences(sizes) == 120 <= len(best[0].bins) < len(plain.bins)
    for n in range(1, 60):
        s = [rng.randrange(1, 1025) for _ in range(n)]
        assert -(-sum(s) // 1024) <= packing.least_sequences(s) <= len(packing.Packing(s).place(sorted(range(n), key=lambda i: -s[i])).bins)


def test_empty(odd):
    none = odd.where("false")
    assert packing.pack(none, BYTES, ["doc_id"]).count() == token_counts.prefix_table(none, MODEL, ["doc_id"]).count() == 0


def test_both_libraries_agree_on_the_whole_class():
    """Texts of usual characters: both libraries class each character alike, and every entry of the vocabulary encodes alike.

    How a text is cut depends on the classes of its characters alone, and how a word is merged on the vocabulary alone.
    """
    encoder = packing.Encoder(open(BYTES, encoding="utf-8").read(), open(RANKS, "rb").read())
    usual = [chr(c) for c in range(0x250) if not packing.UNUSUAL(chr(c))]
    assert len(usual) > 450
    around = ["", " ", "  ", "\n", "a", "1", "!", "'", "a'", "'s", "é"]
    texts = [x + c + y for c in usual for x in around for y in around]
    texts += [x + c + y + "ab" for c in " \t\n\r" for x in usual for y in usual]
    words = [encoder.library.decode([i]) for i in range(encoder.library.get_vocab_size())]
    texts += [w for w in words if not packing.UNUSUAL(w)] + [w + w for w in words if not packing.UNUSUAL(w)]
    found = encoder.library.encode_batch(texts, add_special_tokens=False)
    for t, f in zip(texts, found):
        assert not packing.UNUSUAL(t) and encoder.fast(t) == f.ids, repr(t)


def test_evolution_gains_on_best_fit():
    """Instances that best fit alone packs badly: the least number of sequences is known for the first."""
    rng = random.Random(1)
    triplets = []
    for _ in range(200):
        a = rng.randrange(390, 500)
        b = rng.randrange((1024 - a) // 2 - 60, (1024 - a) // 2)
        triplets += [a, b, 1024 - a - b]
    for sizes, gain in ((triplets, 12), ([rng.randrange(200, 700) for _ in range(1500)], 4)):
        rng.shuffle(sizes)
        best_fit = packing.Packing(sizes).place(sorted(range(len(sizes)), key=lambda i: -sizes[i]))
        population = packing.evolve(sizes, [], random.Random(2))
        best = population[0]
        assert sorted(i for b in best.bins for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= packing.ROOM for b in best.bins)
        assert packing.least_sequences(sizes) <= len(best.bins) <= len(best_fit.bins) - gain
