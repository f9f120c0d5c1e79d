"""Edge semantics of ranges, reports, readers and writers on hand-made rows."""

import random
import time
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helixtable.functions import columns as C
from helixtable.operators import catalog, ranges, reports, seeds
from helixtable.operators import hits as H
from helixtable.scratch import shared_folder
from helixtable.sources import readers as R
from helixtable.sources import writers as W
from helixtable.streaming.incremental import ingest_increment

BY = ["species", "domain", "incomplete", "chromosome", "strand"]


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


def test_means_of_incomplete_members_are_null(spark):
    df = spark.createDataFrame([("s", "d", "-", "c", "+", 1, 5, 2.0), ("s", "d", "-", "c", "+", 4, 9, None), ("s", "e", "N", "c", "+", 1, 5, 4.0)], "species string, domain string, incomplete string, chromosome string, strand string, start long, end long, bitscore double")
    assert {r.domain: (r.mean_bitscore, r.members) for r in ranges.reduce_ranges(df).collect()} == {"d": (None, 2), "e": (4.0, 1)}
    assert {r.domain: r.bitscore for r in reports.completeness(df).collect()} == {"d": None, "e": 4.0}


@pytest.mark.parametrize("codes,best", [(["-", "N"], "W"), (["NC", "N"], "NC"), (["N", "C"], "B"), (["N", "N"], "N"), (["C"], "C"), (["N", None], None), (["N", "C", None], "B"), ([None], None)])
def test_best_code(spark, codes, best):
    df = spark.createDataFrame([("s", "d", c, 1.0) for c in codes], "species string, domain string, incomplete string, bitscore double")
    assert reports.completeness(df).first().incomplete == best


def merged(rows, gap=1):
    out = []
    for s, e in sorted(rows):
        if out and s <= out[-1][1] + gap:
            out[-1][1] = max(out[-1][1], e)
            out[-1][2] += 1
        else:
            out.append([s, e, 1])
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 12), st.sampled_from("ab")), min_size=1, max_size=40), st.sampled_from([None, 7, 1000]))
def test_ranges_have_the_properties(spark, rows, bins):
    df = spark.createDataFrame([("s", d, "-", "c", "+", a, a + n, 1.0) for a, n, d in rows], "species string, domain string, incomplete string, chromosome string, strand string, start long, end long, bitscore double").repartition(3)
    got = ranges.reduce_ranges(df, bin_size=bins)
    by = defaultdict(list)
    for r in got.collect():
        by[r.domain].append([r.start, r.end, r.members])
        assert r.width == r.end - r.start + 1 and r.mean_bitscore == 1.0
    assert {d: sorted(v) for d, v in by.items()} == {d: merged([(a, a + n) for a, n, x in rows if x == d]) for d in {x for *_, x in rows}}
    again = ranges.reduce_ranges(got.withColumnRenamed("mean_bitscore", "bitscore"))
    assert again.count() == got.count()


@pytest.mark.parametrize("size, gap", [(16, 1), (64, 0), (7, 5)])
def test_ranges_over_many_bins(spark, size, gap):
    """Groups, also with nulls in their keys, whose ranges cross no edge, one, or very many of the bins."""
    rng = random.Random(size)
    rows = [(d, rng.choice(["+", None]), a, a + rng.choice([0, 3, 10, 40])) for d in "abcdef" for a in rng.choices(range(-50, 3000), k=120)]
    rows += [("a", "+", 100, 1900), ("b", None, 5, 2000), ("b", None, 1990, 2500), ("g", "+", 3, 4), ("h", None, 15, 16)]
    df = spark.createDataFrame([("s", d, None, "c", x, a, e, 1.0) for d, x, a, e in rows], "species string, domain string, incomplete string, chromosome string, strand string, start long, end long, bitscore double").repartition(5)
    got = defaultdict(list)
    for r in ranges.reduce_ranges(df, min_gap=gap, bin_size=size).collect():
        got[r.domain, r.strand].append([r.start, r.end, r.members])
    assert {k: sorted(v) for k, v in got.items()} == {k: merged([(a, e) for d, x, a, e in rows if (d, x) == k], gap) for k in {r[:2] for r in rows}}


def test_files_are_few_and_of_bounded_size(spark, tmp_path):
    """A folder for each species with one file from many tasks, and several where a species is large."""
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, concat('s', id % 7), 'large') as species", "concat('h', id) as header", "repeat(substr(sha(cast(id as string)), 1, 10), 20) as sequence").repartition(20)
    assert W.write_fasta(rows, str(tmp_path / "fa")) and W.write_parquet(rows, str(tmp_path / "pq"))
    for kind, suffix in (("fa", "txt"), ("pq", "parquet")):
        counts = Counter(f.parent.name for f in (tmp_path / kind).rglob(f"*.{suffix}"))
        assert len(counts) == 8 and max(counts.values()) == 1
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        W.write_fasta(rows, str(tmp_path / "more"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    counts = Counter(f.parent.name for f in (tmp_path / "more").rglob("*.txt"))
    # species that share a partition with a large one are split with it; 20 tasks would write 160 files
    assert counts["species=large"] > 2 and counts.total() < 40


def test_gap_of_one_base_separates(spark):
    df = spark.createDataFrame([("s", "d", "-", "c", "+", a, b, 1.0) for a, b in [(1, 10), (11, 20), (22, 30), (2, 3)]], "species string, domain string, incomplete string, chromosome string, strand string, start long, end long, bitscore double")
    assert sorted((r.start, r.end) for r in ranges.reduce_ranges(df).collect()) == [(1, 20), (22, 30)]


def test_strand_before_order_and_nulls(spark):
    df = spark.createDataFrame([("x NC_1.1|", 9, 3), ("NC_2", 5, 5), ("?", 1, 2), ("NC_3", None, 4)], "chromosome string, start_pos long, end_pos long")
    got = {r.chromosome: (r.strand, r.start, r.end) for r in ranges.normalize(df).collect()}
    assert got == {"NC_1.1": ("-", 3, 9), "NC_2": ("-", 5, 5), None: ("+", 1, 2), "NC_3": (None, None, None)}
    good, bad = ranges.split_valid(ranges.normalize(df))
    assert (good.count(), bad.count()) == (2, 2)


@pytest.mark.parametrize("size", [4, 1 << 20])
def test_ranges_are_computed_once(spark, size):
    """Also where ranges cross the edges of bins, and where groups hold nulls."""
    seen = spark.sparkContext.accumulator(0)

    def part(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [("s", None, "-", "NC_1", "+", 1, 9, 2.0), ("s", None, "-", "NC_1", "+", 8, 14, 4.0), ("s", "d", "-", "NC_1", "+", 8, 9, 1.0)]
    schema = "species string, domain string, incomplete string, chromosome string, strand string, start long, end long, bitscore double"
    df = spark.createDataFrame(rows, schema).mapInArrow(part, schema)
    got = sorted((r.domain or "", r.start, r.end, r.mean_bitscore, r.members) for r in ranges.reduce_ranges(df, bin_size=size).collect())
    assert got == [("", 1, 14, 3.0, 2), ("d", 8, 9, 1.0, 1)] and seen.value == 3


def test_labels_and_parsing(spark):
    assert one(spark, "NC_1.1:5-90|tag:AB12CD", C.tag_of) == "AB12CD"
    assert one(spark, "NC_1.1:5-90|tag:AB12CD", C.without_tags) == "NC_1.1:5-90"
    assert one(spark, "no tag", C.tag_of) is None
    assert spark.createDataFrame([("NC_1.1:5-90|tag:X",), ("plain-text",)], "v string").select(*C.location(F.col("v"))).collect() == [("NC_1.1", "5", "90"), ("", "", "")]
    assert one(spark, "Genus_x.FNA", C.species_from_file) == "Genus_x" and one(spark, "a.fa.txt", C.species_from_file) == "a.fa.txt"
    assert [one(spark, v, C.accession_kind) for v in ("GCF_1.1", "ABC12345", "x NP_1.2", "Homo")] == ["assembly", "protein", "accession", "search term"]
    assert [one(spark, v, C.level_rank) for v in ("Complete", "Complete Genome", "Contig", "None")] == [1, 1, 4, None]
    assert [one(spark, v, C.long_of) for v in ("12.7", "x", "-3.9")] == [12, None, -3]
    assert [one(spark, v, C.contingency_label) for v in ("-", "NC", "N", "C", "?")] == ["Complete", "Bitruncated", "N-Truncated", "C-Truncated", None]


def test_hits(spark):
    df = spark.createDataFrame([("a", "60", "x"), ("a", "70", "y"), ("a", "60", "z"), ("b", "bad", "x"), ("c", None, "x")], "query_id string, pct_identity string, tag string")
    good, bad = H.cast_hits(df)
    assert (good.count(), bad.count()) == (4, 1) and good.schema["pct_identity"].dataType.simpleString() == "double"
    assert H.coerce_dropna(df, ["pct_identity"]).count() == 3
    assert H.dedupe_hits(df).count() == 4
    with pytest.raises(Exception):
        H.cast_hits(df, strict=True)[0].collect()
    tags = H.tag_hits(df, 8)
    assert sorted(tags.collect()) == sorted(H.tag_hits(df.repartition(3), 8).collect()) and all(len(r.tag) == 8 for r in tags.collect())
    assert H.tag_clashes(tags).count() == 1  # the two rows that are equal but for the tag


def test_no_hit_cells_cover_all_listed_species(spark):
    df = spark.createDataFrame([("a", "d", "-", 1.0), ("z", "d", "N", 1.0)], "species string, domain string, incomplete string, bitscore double")
    listed = spark.createDataFrame([("a",), ("b",)], "species string")
    assert Counter((r.species, r.rank) for r in reports.completeness_grid(df, listed).collect()) == Counter([("a", 1), ("a", 4), ("b", 4), ("z", 2)])
    assert Counter((r.species, r.rank) for r in reports.completeness_grid(df, listed, best=True).collect()) == Counter([("a", 1), ("b", 4), ("z", 2)])
    assert reports.missing_species(listed, df).collect() == [("b",)] and reports.species_intersect(listed, df).collect() == [("a",)]


REPORT = """QUERY\tQ0\tPeptide\t1\tbefore DATA
DATA
SESSION\t1\tRPSBLAST\t2.1\tcdd\tBLOSUM62\t0.01
QUERY\tQ1\tPeptide\t10\tNC_1.1:5-90|tag:AB12CD
DOMAINS
1\tQ1\tSpecific\t11\t1\t9\t1e-5\t50\tcd1\tdomA\t-\t99
  1\tQ1\tSpecific\t12\t1\t9\t1e-5\t60\tcd2\tdomB\tN\t-\x20
1\tQ1\tshort
1\tQ1\tSpecific\t13\t1\t9\t1e-5\t60\tcd2\tdomC\tN\t
ENDDOMAINS
SITES
1\tQ1\tx
ENDSITES
ENDQUERY
QUERY\tQ2\tPeptide\t10\tNC_2.1
ENDQUERY
QUERY\tQ3\tPeptide\t10\tno location
DOMAINS
ENDDOMAINS
ENDQUERY
QUERY\tQ4\tPeptide\t10\tx

DOMAINS
1\tQ4\tSpecific\t11\t1\t9\t1e-5\t50\tcd1\tdomZ\t-\t99
ENDDOMAINS
ENDQUERY
ENDSESSION
SESSION\t2\tRPSTBLASTN\t2.2\tcdd2\tBLOSUM80\t0.1
QUERY\tQ5\tNucleotide\t7\tNC_5.1:1-2
DOMAINS
2\tQ5\tSuper\t1\t1\t2\t0.1\t7\tcl5\tdomD\tNC\t-
"""


@pytest.mark.parametrize("split", [None, 64])
def test_domain_report(spark, tmp_path, split):
    """Also with the file in many splits, where context comes from other blocks."""
    (tmp_path / "Genus_species.out").write_text(REPORT)
    (tmp_path / "Other.out").write_text("DATA\nSESSION\t9\tp\tv\td\tm\t1\nQUERY\tX\tPeptide\t1\tdef\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        good, bad = R.read_domain_report(spark, str(tmp_path))
        rows = good.collect()
        odd = [r.reason for r in bad.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = sorted((r.species, r.query_id, r.domain, r.program, r.chromosome, r.start, r.end, r.tag or "", r.superfamily_pssm_id) for r in rows)
    assert got == sorted([
        ("Genus_species", "Q1", "domA", "RPSBLAST", "NC_1.1", "5", "90", "AB12CD", "99"), ("Genus_species", "Q1", "domB", "RPSBLAST", "NC_1.1", "5", "90", "AB12CD", "-"),
        ("Genus_species", "Q2", "", "RPSBLAST", "", "", "", "", ""), ("Genus_species", "Q4", "", "RPSBLAST", "", "", "", "", ""),
        ("Genus_species", "Q5", "domD", "RPSTBLASTN", "NC_5.1", "1", "2", "", "-"), ("Other", "X", "", "p", "", "", "", "", ""),
    ])
    assert sorted(odd) == ["11 fields", "3 fields"]


def test_fasta_round_trip(spark, tmp_path):
    (tmp_path / "Genus_a.FNA").write_text(">id1 first one\r\nACGT\r\nAC\r\n>id2\nGG\n")
    (tmp_path / "Genus_b.fa").write_text(">only\n")
    (tmp_path / "notes.txt").write_text(">no\nA\n")
    rows = sorted(tuple(r) for r in R.read_fasta(spark, str(tmp_path)).collect())
    assert rows == [("Genus_a", "id1", "first one", "ACGTAC", 6), ("Genus_a", "id2", "", "GG", 2), ("Genus_b", "only", "", "", 0)]
    assert sorted(r.species for r in R.species_from_files(spark, str(tmp_path)).collect()) == ["Genus_a", "Genus_b"]
    df = spark.createDataFrame([("s", "h", "A" * 130), ("s", "k", "C" * 60)], "species string, header string, sequence string")
    W.write_fasta(df, str(tmp_path / "out"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert Counter(map(len, lines)) == Counter([2, 60, 60, 10, 2, 60])


def test_gff3_file(spark, tmp_path):
    df = spark.createDataFrame([("s", "a;b=c", "-", "NC_1", "+", 5, 9, None), ("s", "d", "N", "NC_1", "+", 1, 4, 2.5)], "species string, domain string, incomplete string, chromosome string, strand string, start long, end long, mean_bitscore double")
    W.write_gff3(df, str(tmp_path / "g"))
    files = list((tmp_path / "g" / "species=s").glob("part-*"))
    assert len(files) == 1
    assert files[0].read_text().splitlines() == ["##gff-version 3", "NC_1\thelixtable\tsequence_feature\t1\t4\t.\t+\t.\tspecies=s;domain=d;incomplete=N;mean_bitscore=2.5", "NC_1\thelixtable\tsequence_feature\t5\t9\t.\t+\t.\tspecies=s;domain=a%3Bb%3Dc;incomplete=-;mean_bitscore=NA"]


GFF3 = "species string, domain string, incomplete string, chromosome string, strand string, start long, end long, mean_bitscore double"


def test_gff3_leaves_nothing_but_its_files(spark, tmp_path):
    """No shuffled ranges and no scratch table are left; a few bytes of the look whether there are lines do not count."""
    shuffles = lambda: {p for p in Path(spark.conf.get("spark.local.dir")).rglob("shuffle_*.data") if p.stat().st_size > 1000}
    hits = spark.range(20_000).selectExpr("concat('s', id % 3) as species", "concat('d', id % 7) as domain", "'-' as incomplete", "'NC_1' as chromosome", "'+' as strand", "id * 10 as start", "id * 10 + 4 as end", "1.5D as bitscore")
    reduced = ranges.reduce_ranges(hits)  # keeps tables of its own, which it reads
    shared = Path(shared_folder(spark)).parent
    tables, files = set(shared.iterdir()), shuffles()
    assert W.write_gff3(reduced, str(tmp_path / "g"))
    for _ in range(100):  # they are taken away soon after
        if not (left := shuffles() - files):
            break
        time.sleep(0.1)
    assert not left and set(shared.iterdir()) == tables
    assert sum(len(p.read_text().splitlines()) for p in (tmp_path / "g").rglob("part-*")) == 20_003


def test_gff3_in_order_over_files(spark, tmp_path):
    """The files of a species are one GFF3 file, whatever the species' name: null and blank ones share a folder, and so a version line."""
    rows = [(s, d, "-", c, x, a, a + n, 1.0) for s in ("large", None, "") for c in ("NC_1", "NC_2") for a in (9, 10, 100) for n in (5, 20, 100) for d in "ab" for x in "-+"]
    random.Random(5).shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        W.write_gff3(spark.createDataFrame(rows, GFF3).repartition(4), str(tmp_path / "g"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    many = False
    for folder, names in (("large", ["large"]), ("__HIVE_DEFAULT_PARTITION__", [None, ""])):
        files = sorted((tmp_path / "g" / f"species={folder}").glob("part-*"))
        first, *lines = [line for f in files for line in f.read_text().splitlines()]
        many |= len(files) > 1
        want = [r for s in names for r in sorted((r for r in rows if r[0] == s), key=lambda r: (r[3], r[5], r[6], r[4], r[1]))]
        assert first == "##gff-version 3"
        assert [line.split("\t") for line in lines] == [[r[3], "helixtable", "sequence_feature", str(r[5]), str(r[6]), ".", r[4], ".", f"species={'NA' if r[0] is None else r[0]};domain={r[1]};incomplete=-;mean_bitscore=1.0"] for r in want]
    assert many


def test_csv2_and_empty_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5)], "species string, x double")
    W.write_csv2(df, str(tmp_path / "c"))
    assert max((p.read_text() for p in (tmp_path / "c").glob("part-*")), key=len) == "species;x\na;1,5\n"
    assert not W.write_parquet(df.where("false"), str(tmp_path / "p")) and not (tmp_path / "p").exists()
    default = spark.createDataFrame([("z",), ("z",)], "species string")
    assert R.species_present(spark, str(tmp_path / "none"), default).collect() == [("z",)]


def test_each_report_is_taken_in_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "A.out").write_text(REPORT)
    run = lambda: ingest_increment(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c"))
    run()
    (tmp_path / "in" / "B.out").write_text(REPORT)
    run()
    run()
    assert {(r.species, r["count"]) for r in spark.read.parquet(str(tmp_path / "t")).groupBy("species").count().collect()} == {("A", 5), ("B", 5)}


def test_assemblies(spark):
    df = spark.createDataFrame([("t", 0, "G1", "Contig"), ("t", 1, "G2", "Complete Genome"), ("t", 2, "G3", "Complete"), ("u", 0, "G4", "odd")], "taxon string, report_index int, accession string, level string")
    assert catalog.best_assembly(df).collect() == [("t", "G2", "Complete Genome")]
    asked = spark.createDataFrame([("t",), ("GCF_9.1",), ("u",)], "query string")
    assert sorted(catalog.resolve_queries(asked, df).collect()) == [("GCF_9.1", "GCF_9.1", "Direct_Accession"), ("t", "G2", "Complete Genome")]


def test_kmers_and_frames(spark):
    df = spark.createDataFrame([(1, "ABCDEFGH"), (2, "AB"), (3, None)], "seq_id long, sequence string")
    want = [(1, "ABCDEFGH"[i : i + 3], i + 1) for i in range(6)]
    for piece in (1, 2, 5, 256):
        assert sorted(tuple(r) for r in seeds.kmers(df, 3, piece=piece).collect()) == want
    dna = spark.createDataFrame([(1, "ATGGCCTAA"), (2, "AT")], "seq_id long, sequence string")
    frames = {(r.seq_id, r.frame): r.protein for r in seeds.six_frames(dna).collect()}
    assert frames[1, 1] == "MA*" and frames[1, 2] == "WP" and frames[1, -1] == "LGH" and frames[2, 1] == ""
    assert [(r.first, r.sequence) for r in seeds.chunked(dna.where("seq_id = 1"), 4, 2).orderBy("first").collect()] == [(1, "ATGGCC"), (5, "CCTAA"), (9, "A")]


def test_quality_of_files(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", ""), ("b", "y")], "file string, seq_id string")
    assert {r.file: (r.records, r.empty_ids, r.distinct_ids, r.valid) for r in catalog.fasta_quality(df).collect()} == {"a": (2, 0, 1, True), "b": (2, 1, 2, False)}


def test_seed_join_keeps_frequent_kmers(spark):
    """A passage in more subjects than any cap keeps all its seeds, with and without salted k-mers."""
    passage = "ACGTTGCAAGCTTAGC"
    subjects = [(i, "C" * (i % 5) + passage) for i in range(60)] + [(99, "TTTT")]
    q = seeds.kmers(spark.createDataFrame([(1, passage)], "query long, sequence string"), 8, "query").withColumnRenamed("pos", "q_pos")
    s = seeds.kmers(spark.createDataFrame(subjects, "subject long, sequence string"), 8, "subject").withColumnRenamed("pos", "s_pos")
    places = lambda text, i: [(i, p + 1, text[p : p + 8]) for p in range(len(text) - 7)]
    want = sorted((1, qp, i, sp) for i, text in subjects for _, sp, k in places(text, i) for _, qp, w in places(passage, 1) if w == k)
    for hot in (1000, 10):
        got = seeds.seed_join(q, s, hot=hot)
        assert sorted(tuple(r) for r in got.collect()) == want
        assert {r.subject for r in seeds.diagonal_hits(got).collect()} == set(range(60))
    assert seeds.seed_join(q, s, 20).count() == 0
