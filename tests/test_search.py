"""Extension, translated search and FASTA pieces against plain Python over whole sequences."""

import random

import pytest
from pyspark.sql import functions as F

from helixtable.operators import extension, seeds, translated
from helixtable.sources.fasta_pieces import read_fasta_pieces
from helixtable.sources.readers import read_fasta


def best(scores, drop):
    """Length and score of the best prefix."""
    total = top = n = 0
    for i, x in enumerate(scores, 1):
        total += x
        if total > top:
            top, n = total, i
        if top - total > drop:
            break
    return n, top


def score(s, x, y):
    if x == y and x not in s.unknown:
        return s.match
    heads = {c: g[0] for g in s.classes for c in g}
    return s.table.get(x + y, s.similar if heads.get(x, x) == heads.get(y, y) and x not in s.unknown else s.mismatch)


def hits(a, b, k, s, drop):
    """Hits of two sequences with their k-mers' seeds: q_start, q_end, diagonal, matches, score, seeds."""
    out = []
    for d in range(1 - len(a), len(b)):
        lo, hi = max(1, 1 - d), min(len(a), len(b) - d)
        same = {r for r in range(lo, hi - k + 2) if a[r - 1 : r - 1 + k] == b[r - 1 + d : r - 1 + d + k] and not set(a[r - 1 : r - 1 + k]) & set(s.unknown)}
        runs = []
        for r in sorted(same):
            if runs and r <= runs[-1][1] + 1:
                runs[-1] = (runs[-1][0], r + k - 1, runs[-1][2] + 1)
            else:
                runs.append((r, r + k - 1, 1))
        v = lambda r: score(s, a[r - 1], b[r - 1 + d])
        found = []
        for f, t, n in runs:
            (ln, ls), (rn, rs) = best([v(r) for r in range(f - 1, lo - 1, -1)], drop), best([v(r) for r in range(t + 1, hi + 1)], drop)
            found.append((f - ln, t + rn, sum(v(r) for r in range(f, t + 1)) + ls + rs, n))
        kept = []
        for x in sorted(found, key=lambda x: (x[0], -x[1])):
            if kept and kept[-1][1] >= x[1]:
                kept[-1] = (*kept[-1][:3], kept[-1][3] + x[3])
            else:
                kept.append(x)
        out += [(f, t, d, sum(a[r - 1] == b[r - 1 + d] and a[r - 1] not in s.unknown for r in range(f, t + 1)), x, n) for f, t, x, n in kept]
    return sorted(out)


def changed(rng, text, letters, rate):
    return "".join(rng.choice(letters) if rng.random() < rate else c for c in text)


SCORINGS = [extension.Scoring(), extension.Scoring(match=2, mismatch=-3, similar=1, classes=("AG", "CT"), unknown="N"), extension.Scoring(table={"AC": 3, "CA": 3})]


@pytest.mark.parametrize("scoring, drop", list(zip(SCORINGS, [20, 5, 12])))
def test_extension(spark, scoring, drop):
    rng = random.Random(drop)
    queries = {f"q{i}": "".join(rng.choices("ACGTN", [5, 5, 5, 5, 1], k=rng.randrange(10, 120))) for i in range(8)} | {"none": "", "short": "AC", "wide": "ACGT\u6f22\U0001f600ACGTACGGT\nAC" * 3}
    subjects = {}
    for i in range(12):
        parts = [changed(rng, rng.choice(list(queries.values())), "ACGT", 0.15)[rng.randrange(5) :] for _ in range(3)]
        subjects[i] = "".join(p + "".join(rng.choices("ACGT", k=rng.randrange(40))) for p in parts)
    q = spark.createDataFrame(list(queries.items()), "query string, sequence string").repartition(2)
    s = spark.createDataFrame([*subjects.items(), (98, ""), (99, None)], "subject long, sequence string").repartition(3)
    found = seeds.seed_join(seeds.kmers(q, 6, "query").withColumnRenamed("pos", "q_pos"), seeds.kmers(s, 6, "subject").withColumnRenamed("pos", "s_pos"))
    if scoring.unknown:
        found = found.join(seeds.kmers(q, 6, "query").where(~F.contains("kmer", F.lit("N"))).withColumnRenamed("pos", "q_pos").drop("kmer"), ["query", "q_pos"])
    want = sorted((name, i, *h) for name, a in queries.items() for i, b in subjects.items() for h in hits(a, b, 6, scoring, drop))
    for width in (16, 1024):
        got = extension.extend_seeds(found, q, extension.blocks_of(s, width), 6, scoring, drop, width).collect()
        assert sorted((r.query, r.subject, r.q_start, r.q_end, r.s_start - r.q_start, r.matches, r.score, r.seed_count) for r in got) == want
    assert len(want) > 30
    for r in got:
        assert r.subject_sequence == subjects[r.subject][r.s_start - 1 : r.s_end] and r.aln_len == r.q_end - r.q_start + 1 == r.matches + r.mismatches
        assert r.pct_identity == r.matches * 100.0 / r.aln_len
    assert extension.extend_seeds(found.where("false"), q, extension.blocks_of(s), 6).count() == 0
    kept = extension.within(extension.extend_seeds(found, q, extension.blocks_of(s), 6, scoring, drop), 80.0, 20, 40).collect()
    assert kept and len(kept) == sum(m * 100 / (t - f + 1) >= 80 and t - f + 1 >= 20 and x >= 40 for _, _, f, t, _, m, x, _ in want)


PAIRS = str.maketrans("ACGT", "TGCA")


def protein(dna):
    return "".join(seeds.CODONS.get(dna[i : i + 3], "X") for i in range(0, len(dna) - 2, 3))


def test_translated_search(spark, tmp_path):
    """Hits on both strands of records that lie across file splits and pieces, with places on the genome."""
    rng = random.Random(5)
    dna = lambda n: "".join(rng.choices("ACGTN", [9, 9, 9, 9, 0.3], k=n))
    genes = [dna(rng.randrange(30, 240)) for _ in range(6)]
    queries = {i: changed(rng, protein(g), "ACDEFGHIKLMNPQRSTVWYX", 0.05) for i, g in enumerate(genes)} | {90: "", 91: "MK"}
    genomes = {}
    for i in range(5):
        parts = [g if rng.random() < 0.5 else g[::-1].translate(PAIRS) for g in rng.sample(genes, 3)]
        genomes[f"chr{i}"] = dna(rng.randrange(80)) + "".join(changed(rng, p, "ACGT", 0.02) + dna(rng.randrange(60)) for p in parts)
    genomes["chr5"], genomes["chr6"] = "AC", ""
    k, want = 4, []
    for i, a in queries.items():
        for name, plus in genomes.items():
            for strand, text in (("+", plus), ("-", plus[::-1].translate(PAIRS))):
                for f in range(3):
                    for start, end, d, matches, x, n in hits(a, protein(text[f:]), k, extension.PROTEIN, 20):
                        first, last = f + 1 + 3 * (start + d - 1), f + 3 * (end + d)
                        places = (first, last) if strand == "+" else (len(plus) + 1 - first, len(plus) + 1 - last)
                        want.append((i, name, strand, start, end, *places, matches, x, n))
    q = spark.createDataFrame(list(queries.items()), "query long, sequence string")
    (tmp_path / "wild.fa").write_text("".join(f">{n} a genome\n" + "".join(f"{s[i : i + 60].lower() if i % 120 else s[i : i + 60]}\n" for i in range(0, len(s), 60)) for n, s in genomes.items()))
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for c in old:
        spark.conf.set(c, "200")
    try:
        for width in (32, 1024):
            pieces = read_fasta_pieces(spark, str(tmp_path), width, translated.overlap(k)).withColumnRenamed("seq_id", "subject")
            got = translated.translated_search(q, pieces, k, width).collect()
            assert sorted((r["query"], r.subject, r.strand, r.q_start, r.q_end, r.s_start, r.s_end, r.matches, r.score, r.seed_count) for r in got) == sorted(want)
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert {w[2] for w in want} == {"+", "-"} and len(want) > 30
    whole = seeds.chunked(spark.createDataFrame(list(genomes.items()), "subject string, sequence string"), 1024, translated.overlap(k), "subject")
    places = translated.genome_kmers(whole, k, 1024)
    assert places.count() == sum("X" not in protein(t[f : f + 3 * k]) for s in genomes.values() for t in (s, s[::-1].translate(PAIRS)) for f in range(len(t) - 3 * k + 1))
    assert translated.translated_search(q, whole.where("false"), k).count() == 0


def test_fasta_pieces(spark, tmp_path):
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choices("ACGT", k=n))
    text = ""
    for i in range(40):
        s = letters(rng.choice([0, 1, 31, 32, 33, 200, 1500]))
        text += f">r{i % 30} about {i}\r\n" + "".join(f"{s[j : j + w]}\n" + "\n" * (j % 5 == 0) for w in [rng.choice([10, 60])] for j in range(0, len(s), w))
    (tmp_path / "a.fa").write_text(text)
    (tmp_path / "b.fasta").write_text("before the first\n>only\nAC GT\tAC\n>wide\n\u6f22\u5b57AB\n\U0001f600" + "C" * 70)
    (tmp_path / "c.fna").write_text("")
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    whole = {(r.species, r.seq_id, r.description, r.sequence) for r in read_fasta(spark, str(tmp_path)).collect() if r.seq_id != "before"}
    try:
        for size in ("300", "1000000"):
            for c in old:
                spark.conf.set(c, size)
            for width, beyond in ((32, 45), (1000, 0)):
                records = {}
                for r in read_fasta_pieces(spark, str(tmp_path), width, beyond).collect():
                    assert (r["first"] - 1) % width == 0
                    records.setdefault((r.species, r.record, r.seq_id, r.description), {})[(r["first"] - 1) // width] = r.sequence
                assert len(records) == 42 and sorted(n for s, n, *_ in records if s == "a") == list(range(1, 41))
                joined = {}
                for key, pieces in records.items():
                    s = "".join(pieces[i][:width] for i in range(len(pieces)))
                    assert pieces == {i: s[i * width : (i + 1) * width + beyond] for i in range(max(1, -(-len(s) // width)))}
                    joined[key] = s
                assert {(sp, name, about, s) for (sp, _, name, about), s in joined.items()} == whole
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_long_sequences_are_cut_in_linear_time(spark):
    """Some megabytes in one row: with a cost in proportion to the place this would take hours."""
    for letters in ("ACGTTGCAAT", "ACGT\u6f22CAAT\U0001f600"):
        df = spark.range(1).select(F.lit(1).alias("seq_id"), F.repeat(F.lit(letters), 300_000).alias("sequence"))
        got = seeds.kmers(df, 10).groupBy("kmer").agg(F.count("*").alias("n"), F.max("pos").alias("last")).collect()
        want = {(letters * 2)[i : i + 10]: (300_000 - (i > 0), 10 * (300_000 - 1 - (i > 0)) + i + 1) for i in range(10)}
        assert {r.kmer: (r.n, r.last) for r in got} == want
        assert seeds.chunked(df, 1000, 5).agg(F.sum(F.length("sequence"))).first()[0] == 3_000_000 + 2999 * 5
