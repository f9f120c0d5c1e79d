"""Registered queries of the library's own operators, each with DuckDB SQL over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtable.functions import columns as C
from helixtable.operators import catalog, ranges, reports, seeds, species
from helixtable.operators import hits as H
from helixtable.plans import binding as B
from helixtable.plans import round_trips, search

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, oracle
        return f

    return add


def _ranges(spark: SparkSession, sf: str) -> DataFrame:
    return ranges.reduce_ranges(ranges.normalize(B.hits(spark, sf)))


def _nations(spark: SparkSession, sf: str) -> DataFrame:
    return B.table(spark, sf, "nation").select(F.col("n_name").alias("species"))


def _rich(spark: SparkSession, sf: str) -> DataFrame:
    """Species whose suppliers have more than 4500 on average."""
    s = B.table(spark, sf, "supplier").join(B.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.groupBy(F.col("n_name").alias("species")).agg(F.avg("s_acctbal").alias("mean")).where("mean > 4500").select("species")


RICH = "rich AS (SELECT n_name AS species FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name HAVING avg(s_acctbal) > 4500)"


# -- scans, filters, scalar functions


@query("SELECT l_orderkey, l_partkey, l_quantity, l_tax FROM lineitem")
def scan_parquet(spark, sf):
    return B.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_tax")


@query(f"WITH {B.HITS} SELECT species, domain, pct_identity, evalue, aln_len, bitscore FROM hits WHERE pct_identity >= 60 AND evalue <= 0.01 AND aln_len >= 50 AND bitscore >= 70")
def filter_hits(spark, sf):
    return H.filter_hits(B.hits(spark, sf)).select("species", "domain", "pct_identity", "evalue", "aln_len", "bitscore")


@query(f"WITH {B.NORMAL} SELECT species, chromosome, start_pos FROM (SELECT species, nullif(regexp_extract(chromosome, '[A-Za-z]+_?[0-9]+[._]?[0-9]*', 0), '') AS chromosome, start_pos FROM hits)")
def extract_accession(spark, sf):
    return B.hits(spark, sf).select("species", C.accession(F.col("chromosome")).alias("chromosome"), "start_pos")


@query(f"WITH {B.HITS} SELECT start_pos, end_pos, CASE WHEN start_pos < end_pos THEN '+' WHEN start_pos >= end_pos THEN '-' END AS strand FROM hits")
def derive_strand(spark, sf):
    return B.hits(spark, sf).select("start_pos", "end_pos", C.strand(F.col("start_pos"), F.col("end_pos")).alias("strand"))


@query(f'WITH {B.NORMAL} SELECT species, domain, incomplete, bitscore, chromosome, strand, "start", "end" FROM normal')
def normalize_coords(spark, sf):
    return ranges.normalize(B.hits(spark, sf).select("species", "domain", "incomplete", "bitscore", "chromosome", "start_pos", "end_pos"))


@query(f"WITH {B.HITS}, blank AS (SELECT species, CASE WHEN p_size > 48 THEN '' ELSE domain END AS domain, bitscore FROM hits) SELECT * FROM blank WHERE domain <> '' OR domain IS NULL")
def nonempty_domain(spark, sf):
    blank = B.hits(spark, sf).select("species", F.when(F.col("p_size") > 48, "").otherwise(F.col("domain")).alias("domain"), "bitscore")
    return reports.nonempty_domain(blank)


@query(f"WITH {B.HITS} SELECT DISTINCT domain FROM hits")
def distinct_domains(spark, sf):
    return reports.distinct_values(B.hits(spark, sf), "domain")


@query("SELECT doc_id, replace(replace(text, '-', ''), '*', '') AS sequence FROM documents")
def ungap_sequence(spark, sf):
    return B.table(spark, sf, "documents").select("doc_id", C.ungap(F.col("text")).alias("sequence"))


def _headers(spark, sf):
    tag = F.substring(F.lpad(F.upper(F.hex(F.col("l_orderkey"))), 6, "0"), 1, 6)
    start = F.col("l_partkey") * 10
    rows = B.table(spark, sf, "lineitem")
    subject = F.concat(F.lit("NC_"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0"), F.lit(".1"))
    return rows.select("l_orderkey", "l_linenumber", subject.alias("subject"), start.alias("s"), (start + F.col("l_quantity").cast("long")).alias("e"), tag.alias("t"))


HEADERS = """headers AS (
    SELECT l_orderkey, l_linenumber, concat('NC_', CASE WHEN length(CAST(l_suppkey AS VARCHAR)) < 6 THEN lpad(CAST(l_suppkey AS VARCHAR), 6, '0') ELSE CAST(l_suppkey AS VARCHAR) END, '.1') AS subject,
        l_partkey * 10 AS s, l_partkey * 10 + CAST(l_quantity AS BIGINT) AS e, lpad(upper(printf('%x', l_orderkey)), 6, '0') AS t
    FROM lineitem
), texts AS (SELECT *, concat(subject, ':', s, '-', e, '|tag:', t) AS header FROM headers)"""


@query(f"WITH {HEADERS} SELECT l_orderkey, l_linenumber, header FROM texts")
def fasta_header(spark, sf):
    h = _headers(spark, sf)
    return h.select("l_orderkey", "l_linenumber", C.fasta_header(F.col("subject"), F.col("s"), F.col("e"), F.col("t")).alias("header"))


@query(f"WITH {HEADERS} SELECT l_orderkey, l_linenumber, concat(subject, ':', s, '-', e) AS query_id, t AS tag FROM texts")
def extract_tag(spark, sf):
    return H.extract_tags(fasta_header(spark, sf).withColumnRenamed("header", "query_id")).select("l_orderkey", "l_linenumber", "query_id", "tag")


@query(f"""WITH {HEADERS} SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN '' ELSE subject END AS chromosome,
    CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(s AS VARCHAR) END AS "start", CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(e AS VARCHAR) END AS "end" FROM texts""")
def parse_location(spark, sf):
    h = fasta_header(spark, sf)
    text = F.when(F.col("l_linenumber") == 1, F.replace("header", F.lit(":"), F.lit("/"))).otherwise(F.col("header"))
    parts = C.location(text)
    return h.select("l_orderkey", "l_linenumber", *[p.alias(n) for p, n in zip(parts, ("chromosome", "start", "end"))])


def _texts(spark, sf):
    """Numbers as text, every 17th order's spoiled."""
    bad = F.when(F.col("l_orderkey") % 17 == 0, "x").otherwise("")
    rows = B.table(spark, sf, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", F.concat(F.col("l_partkey").cast("string"), bad).alias("aln_len"), F.concat(F.col("l_quantity").cast("long").cast("string"), F.lit(".5"), bad).alias("bitscore"))


TEXTS = """spoiled AS (
    SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) || CASE WHEN l_orderkey % 17 = 0 THEN 'x' ELSE '' END AS aln_len,
        CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.5' || CASE WHEN l_orderkey % 17 = 0 THEN 'x' ELSE '' END AS bitscore
    FROM lineitem
)"""


@query(f"WITH {TEXTS} SELECT l_orderkey, l_linenumber, try_cast(aln_len AS BIGINT) AS aln_len, try_cast(bitscore AS DOUBLE) AS bitscore, false AS quarantined FROM spoiled WHERE l_orderkey % 17 <> 0 "
       "UNION ALL SELECT l_orderkey, l_linenumber, NULL, NULL, true FROM spoiled WHERE l_orderkey % 17 = 0")  # fmt: skip
def cast_hits(spark, sf):
    good, bad = H.cast_hits(_texts(spark, sf), ["bitscore"], ["aln_len"])
    odd = bad.select("l_orderkey", "l_linenumber", F.lit(None).cast("long").alias("aln_len"), F.lit(None).cast("double").alias("bitscore"), F.lit(True).alias("quarantined"))
    return good.withColumn("quarantined", F.lit(False)).unionByName(odd)


@query(f"WITH {TEXTS} SELECT l_orderkey, l_linenumber, try_cast(aln_len AS DOUBLE) AS aln_len, try_cast(bitscore AS DOUBLE) AS bitscore FROM spoiled WHERE try_cast(aln_len AS DOUBLE) IS NOT NULL AND try_cast(bitscore AS DOUBLE) IS NOT NULL")
def coerce_dropna(spark, sf):
    return H.coerce_dropna(_texts(spark, sf), ["aln_len", "bitscore"])


@query(f"WITH {TEXTS} SELECT l_orderkey, l_linenumber, try_cast(bitscore AS DOUBLE) AS bitscore, CAST(trunc(try_cast(bitscore AS DOUBLE)) AS BIGINT) AS \"start\", try_cast(aln_len AS BIGINT) AS \"end\" FROM spoiled")
def cast_domains(spark, sf):
    return H.cast_domains(_texts(spark, sf).select("l_orderkey", "l_linenumber", "bitscore", F.col("bitscore").alias("start"), F.col("aln_len").alias("end")))


@query("SELECT DISTINCT l_suppkey, l_quantity, l_tax, l_discount, l_returnflag FROM lineitem")
def dedupe_hits(spark, sf):
    rows = B.table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_tax", "l_discount", "l_returnflag")
    return H.dedupe_hits(rows.withColumn("tag", F.lit("a")))


@query("SELECT event_id, user_id, event_type, props, upper(substr(sha256(concat_ws(chr(31), CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type, props)), 1, 6)) AS tag FROM events")
def tag_hits(spark, sf):
    return H.tag_hits(B.table(spark, sf, "events").select("event_id", "user_id", "event_type", "props"))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' ELSE l_returnflag END AS flag FROM lineitem),
    d AS (SELECT *, upper(sha256(concat(length(CAST(l_orderkey AS VARCHAR)), ':', l_orderkey, length(CAST(l_linenumber AS VARCHAR)), ':', l_linenumber, coalesce(length(flag) || ':' || flag, '-')))) AS h FROM r),
    c AS (SELECT *, count(DISTINCT h) OVER (PARTITION BY substr(h, 1, 4)) AS c4, count(DISTINCT h) OVER (PARTITION BY substr(h, 1, 8)) AS c8, count(DISTINCT h) OVER (PARTITION BY substr(h, 1, 16)) AS c16 FROM d)
    SELECT l_orderkey, l_linenumber, flag, substr(h, 1, CASE WHEN c4 = 1 THEN 4 WHEN c8 = 1 THEN 8 WHEN c16 = 1 THEN 16 ELSE 32 END) AS tag FROM c""")
def unique_tags(spark, sf):
    """Tags of four letters at least, so that many clash."""
    flag = F.when(F.col("l_linenumber") == 2, "").when(F.col("l_linenumber") > 2, F.col("l_returnflag"))
    return H.unique_tags(B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", flag.alias("flag")), 4)


@query("SELECT DISTINCT lang, source, text FROM (SELECT lang, source, text FROM documents UNION ALL SELECT lang, source, text FROM documents WHERE doc_id % 3 = 0)")
def dedupe_wide(spark, sf):
    docs = B.table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    return H.dedupe_wide(docs.union(docs.where("doc_id % 3 = 0")).drop("doc_id"))


@query("""WITH codes AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN concat('GCF_', lpad(CAST(o_custkey AS VARCHAR), 9, '0'), '.1')
        WHEN 1 THEN concat('ABC', lpad(CAST(o_custkey AS VARCHAR), 5, '0')) WHEN 2 THEN concat('NP_', o_custkey, '.2') ELSE concat('Homo species ', o_custkey) END AS query FROM orders)
    SELECT o_orderkey, query, CASE WHEN regexp_matches(query, '^GC[AF]_[0-9]+(\\.[0-9]+)?$') THEN 'assembly' WHEN regexp_matches(query, '^[A-Z]{3}[0-9]{5}(\\.[0-9]+)?$') THEN 'protein'
        WHEN regexp_matches(query, '[A-Z]{2,}_?[0-9]+\\.[0-9]{1,2}') THEN 'accession' ELSE 'search term' END AS kind FROM codes""")
def classify_accession(spark, sf):
    k, c = F.col("o_orderkey") % 4, F.col("o_custkey").cast("string")
    text = F.when(k == 0, F.concat(F.lit("GCF_"), F.lpad(c, 9, "0"), F.lit(".1"))).when(k == 1, F.concat(F.lit("ABC"), F.lpad(c, 5, "0")))
    text = text.when(k == 2, F.concat(F.lit("NP_"), c, F.lit(".2"))).otherwise(F.concat(F.lit("Homo species "), c))
    rows = B.table(spark, sf, "orders").select("o_orderkey", text.alias("query"))
    return rows.withColumn("kind", C.accession_kind(F.col("query")))


@query("SELECT p_partkey, replace(p_name, ' ', '_') AS name FROM part")
def safe_name(spark, sf):
    return B.table(spark, sf, "part").select("p_partkey", C.safe_name(F.col("p_name")).alias("name"))


@query("SELECT s_suppkey, n_name AS species FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def species_from_file(spark, sf):
    rows = B.table(spark, sf, "supplier").join(B.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    suffix = F.element_at(F.array(*[F.lit(x) for x in (".fasta", ".FNA", ".fas", ".fa")]), (F.col("s_suppkey") % 4 + 1).cast("int"))
    return rows.select("s_suppkey", C.species_from_file(F.concat("n_name", suffix)).alias("species"))


# -- ranges and reports


@query(f'WITH {B.RANGES} SELECT species, domain, incomplete, chromosome, strand, "start", "end", width, mean_bitscore, members FROM ranges')
def reduce_ranges(spark, sf):
    return _ranges(spark, sf)


@query(f'WITH {B.RANGES} SELECT species, domain, incomplete, chromosome, strand, "start", "end", width, mean_bitscore, members FROM ranges')
def reduce_ranges_binned(spark, sf):
    return ranges.reduce_ranges(ranges.normalize(B.hits(spark, sf)), bin_size=500)


_SPOILED = "CASE WHEN p_size > 45 THEN '?' ELSE chromosome END AS chromosome, CASE WHEN p_size = 1 THEN NULL ELSE start_pos END AS start_pos"


def _spoiled(spark, sf):
    """Hits of which some have no accession as chromosome and some no start."""
    size = F.col("p_size")
    return ranges.normalize(B.hits(spark, sf).withColumns({"chromosome": F.when(size > 45, "?").otherwise(F.col("chromosome")), "start_pos": F.when(size == 1, F.lit(None)).otherwise(F.col("start_pos"))}))


@query(f"""WITH {B.HITS}, spoiled AS (SELECT * REPLACE ({_SPOILED}) FROM hits)
    SELECT species, domain, incomplete, CASE WHEN p_size > 45 THEN NULL ELSE regexp_extract(chromosome, '[A-Za-z]+_?[0-9]+[._]?[0-9]*', 0) END AS chromosome,
        start_pos IS NOT NULL AS has_start FROM spoiled WHERE p_size > 45 OR p_size = 1""")
def rejected_ranges(spark, sf):
    """Ranges that could not be merged, beside the merged ones."""
    _, odd = ranges.merge_ranges(_spoiled(spark, sf))
    # a range without a start has no strand, and its one coordinate stands for both
    return odd.select("species", "domain", "incomplete", "chromosome", F.col("strand").isNotNull().alias("has_start"))


@query(f'WITH {B.RANGES} SELECT species, domain, incomplete, count(*) AS "count" FROM ranges GROUP BY ALL')
def range_counts(spark, sf):
    return reports.range_counts(_ranges(spark, sf))


@query(f"WITH {B.CONTINGENCY} SELECT * FROM table_cells")
def contingency(spark, sf):
    return reports.contingency(_ranges(spark, sf))


@query(f'WITH {B.CONTINGENCY} SELECT DISTINCT incomplete AS label FROM table_cells')
def contingency_label(spark, sf):
    return _ranges(spark, sf).select(C.contingency_label(F.col("incomplete")).alias("label")).distinct()


@query(f"""WITH {B.CONTINGENCY}, busy AS (SELECT * FROM table_cells WHERE "count" > 0)
    SELECT species, domain, incomplete, "count", CAST(dense_rank() OVER (ORDER BY species) AS INT) AS x, CAST(dense_rank() OVER (ORDER BY domain) AS INT) AS y,
        CASE incomplete WHEN 'Complete' THEN 1 WHEN 'N-Truncated' THEN 2 WHEN 'C-Truncated' THEN 3 ELSE 4 END AS z,
        concat('Species: ', species, ' <br> Domain: ', domain, ' <br> Incomplete: ', incomplete, ' <br> Count: ', "count") AS hover, sqrt("count") * 3 AS size FROM busy""")
def scatter_frame(spark, sf):
    return reports.scatter_frame(reports.contingency(_ranges(spark, sf), ordered=False))


@query(f"WITH {B.COMPLETENESS} SELECT species, domain, bitscore, incomplete, incomplete_desc FROM completeness")
def completeness(spark, sf):
    return reports.completeness(B.fine(B.hits(spark, sf)))


@query(f"WITH {B.COMPLETENESS} SELECT DISTINCT incomplete, incomplete_desc FROM completeness")
def completeness_label(spark, sf):
    cells = reports.completeness(B.fine(B.hits(spark, sf))).select("incomplete").distinct()
    return cells.select("incomplete", C.completeness_label(F.col("incomplete")).alias("incomplete_desc"))


@query(f"WITH {B.COMPLETENESS} SELECT * FROM grid")
def completeness_grid(spark, sf):
    return reports.completeness_grid(B.fine(B.hits(spark, sf)), _nations(spark, sf))


@query(f"WITH {B.COMPLETENESS} SELECT DISTINCT incomplete_desc, rank FROM grid")
def completeness_rank(spark, sf):
    labels = reports.completeness_grid(B.fine(B.hits(spark, sf)), _nations(spark, sf)).select("incomplete_desc").distinct()
    return labels.select("incomplete_desc", C.completeness_rank(F.col("incomplete_desc")).alias("rank"))


@query(f"WITH {B.COMPLETENESS} SELECT species, domain, bitscore, incomplete, incomplete_desc, rank FROM grid QUALIFY row_number() OVER (PARTITION BY species, domain ORDER BY rank) = 1")
def completeness_best(spark, sf):
    return reports.completeness_grid(B.fine(B.hits(spark, sf)), _nations(spark, sf), best=True)


@query(f"""WITH {B.COMPLETENESS} SELECT species, domain, CAST(dense_rank() OVER (ORDER BY domain DESC) AS INT) AS domain_order, bitscore, incomplete, incomplete_desc, rank,
    CASE WHEN incomplete IN ('N', 'C', 'B') THEN incomplete ELSE '' END AS label FROM grid""")
def tile_frame(spark, sf):
    return reports.tile_frame(completeness_grid(spark, sf))


# -- species


def _misread(spark, sf):
    """Hits with numbers as text; one nation in five has some that are none."""
    rows = B.table(spark, sf, "lineitem").join(B.table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(B.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    bad = F.when((F.col("l_orderkey") % 17 == 0) & (F.col("n_nationkey") % 5 == 0), "x").otherwise("")
    return rows.select(F.col("n_name").alias("species"), "l_orderkey", "l_linenumber", F.concat(F.col("l_quantity").cast("long").cast("string"), F.lit(".5")).alias("bitscore"), F.concat(F.col("l_partkey").cast("string"), bad).alias("aln_len"))


MISREAD = """spoiled AS (SELECT n_name AS species, l_orderkey, l_linenumber, concat(CAST(l_quantity AS BIGINT), '.5') AS bitscore, concat(l_partkey, CASE WHEN l_orderkey % 17 = 0 AND n_nationkey % 5 = 0 THEN 'x' ELSE '' END) AS aln_len
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
bad AS (SELECT species, count(*) AS rows, count(*) FILTER (WHERE aln_len LIKE '%x') AS bad_rows, concat('aln_len: ', min(aln_len) FILTER (WHERE aln_len LIKE '%x')) AS reason FROM spoiled GROUP BY species)"""


@query(f"""WITH {MISREAD} SELECT species, l_orderkey, l_linenumber, CAST(bitscore AS DOUBLE) AS bitscore, CAST(aln_len AS BIGINT) AS aln_len FROM spoiled
    WHERE species IN (SELECT species FROM bad WHERE bad_rows = 0)""")
def cast_by_species(spark, sf):
    return species.cast_by_species(_misread(spark, sf))[0]


@query(f"""WITH {MISREAD}, names AS (SELECT n_name AS species FROM nation WHERE n_nationkey <> 1 UNION SELECT concat('Mus ', lower(r_name)) FROM region)
    SELECT species, CASE WHEN rows IS NULL THEN 'missing' WHEN bad_rows > 0 THEN 'rejected' ELSE 'taken' END AS status, coalesce(rows, 0) AS rows, coalesce(bad_rows, 0) AS bad_rows,
    CASE WHEN bad_rows > 0 THEN reason END AS reason FROM names LEFT JOIN bad USING (species)""")
def species_report(spark, sf):
    regions = B.table(spark, sf, "region").select(F.concat(F.lit("Mus "), F.lower("r_name")).alias("species"))
    names = B.table(spark, sf, "nation").where("n_nationkey <> 1").select(F.col("n_name").alias("species")).union(regions)
    return species.union_with_report(_misread(spark, sf), names)[1]


@query(f"WITH {B.FINE} SELECT n_name AS species, domain, CAST(0 AS DOUBLE) AS bitscore, 'Z' AS incomplete, 'No Hit' AS incomplete_desc FROM nation CROSS JOIN (SELECT DISTINCT domain FROM cells)")
def no_hit_grid(spark, sf):
    return reports.no_hit_grid(_nations(spark, sf), reports.distinct_values(B.fine(B.hits(spark, sf)), "domain"))


@query(f"WITH {RICH} SELECT n_name AS species FROM nation WHERE n_name NOT IN (SELECT species FROM rich)")
def missing_species(spark, sf):
    return reports.missing_species(_nations(spark, sf), _rich(spark, sf))


@query(f"WITH {RICH} SELECT n_name AS species FROM nation INTERSECT SELECT species FROM rich")
def species_intersect(spark, sf):
    return reports.species_intersect(_nations(spark, sf), _rich(spark, sf))


# -- catalogue


def _assemblies(spark, sf):
    p = F.col("o_orderpriority")
    level = F.when(p == "1-URGENT", "Complete Genome").when(p == "2-HIGH", "Chromosome").when(p == "3-MEDIUM", "Scaffold").when(p == "5-LOW", "Contig")
    return B.table(spark, sf, "orders").select(F.col("o_custkey").alias("taxon"), F.col("o_orderkey").alias("report_index"), F.concat(F.lit("GCF_"), F.col("o_orderkey").cast("string"), F.lit(".1")).alias("accession"), level.alias("level"))


@query("""WITH r AS (SELECT o_custkey AS taxon, o_orderkey AS report_index, concat('GCF_', o_orderkey, '.1') AS accession,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'Complete Genome' WHEN '2-HIGH' THEN 'Chromosome' WHEN '3-MEDIUM' THEN 'Scaffold' WHEN '5-LOW' THEN 'Contig' END AS level FROM orders),
    k AS (SELECT *, CASE level WHEN 'Complete Genome' THEN 1 WHEN 'Chromosome' THEN 2 WHEN 'Scaffold' THEN 3 WHEN 'Contig' THEN 4 END AS p FROM r)
    SELECT taxon, accession, level FROM k WHERE p IS NOT NULL QUALIFY row_number() OVER (PARTITION BY taxon ORDER BY p, report_index) = 1""")
def best_assembly(spark, sf):
    return catalog.best_assembly(_assemblies(spark, sf))


@query("""WITH r AS (SELECT CAST(o_custkey AS VARCHAR) AS taxon, o_orderkey AS report_index, concat('GCF_', o_orderkey, '.1') AS accession,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'Complete Genome' WHEN '2-HIGH' THEN 'Chromosome' WHEN '3-MEDIUM' THEN 'Scaffold' WHEN '5-LOW' THEN 'Contig' END AS level FROM orders),
    k AS (SELECT *, CASE level WHEN 'Complete Genome' THEN 1 WHEN 'Chromosome' THEN 2 WHEN 'Scaffold' THEN 3 WHEN 'Contig' THEN 4 END AS p FROM r),
    best AS (SELECT taxon, accession, level FROM k WHERE p IS NOT NULL QUALIFY row_number() OVER (PARTITION BY taxon ORDER BY p, report_index) = 1),
    asked AS (SELECT CAST(c_custkey AS VARCHAR) AS query FROM customer UNION ALL SELECT concat('GCA_', c_custkey, '.2') FROM customer)
    SELECT query, query AS accession, 'Direct_Accession' AS level FROM asked WHERE query LIKE 'GCA%' UNION ALL SELECT query, accession, level FROM asked JOIN best ON query = taxon""")
def resolve_queries(spark, sf):
    """Assembly accessions stand for themselves, taxa take their best assembly."""
    c = F.col("c_custkey").cast("string")
    asked = B.table(spark, sf, "customer").select(F.explode(F.array(c, F.concat(F.lit("GCA_"), c, F.lit(".2")))).alias("query"))
    return catalog.resolve_queries(asked, _assemblies(spark, sf).withColumn("taxon", F.col("taxon").cast("string")))


@query("SELECT o_custkey AS term, concat('NP_', arg_min(o_orderkey, o_orderkey), '.1') AS accession FROM orders GROUP BY o_custkey")
def first_match(spark, sf):
    rows = B.table(spark, sf, "orders").select(F.col("o_custkey").alias("term"), F.col("o_orderkey").alias("rank"), F.concat(F.lit("NP_"), F.col("o_orderkey").cast("string"), F.lit(".1")).alias("accession"))
    return catalog.first_match(rows)


# -- seeds

K, SEEDS = 12, 3
KMERS = """q AS (SELECT item_id AS query, substr(text, CAST(i AS BIGINT), 12) AS kmer, CAST(i AS INT) AS q_pos FROM benchmark, unnest(range(1, length(text) - 10)) u(i))"""
SEED_SQL = KMERS + """, s AS (SELECT doc_id AS subject, substr(text, CAST(i AS BIGINT), 12) AS kmer, CAST(i AS INT) AS s_pos FROM documents, unnest(range(1, length(text) - 10)) u(i)),
seeds AS (SELECT query, q_pos, subject, s_pos FROM q JOIN s USING (kmer))"""


def _sequences(spark, sf, name, key, as_id):
    return B.spread(B.table(spark, sf, name).select(F.col(key).alias(as_id), F.col("text").alias("sequence")))


@query(f"WITH {KMERS} SELECT query, kmer, q_pos FROM q")
def kmers(spark, sf):
    return seeds.kmers(_sequences(spark, sf, "benchmark", "item_id", "query"), K, "query").withColumnRenamed("pos", "q_pos")


@query(f"WITH {SEED_SQL} SELECT query, q_pos, subject, s_pos FROM seeds")
def seed_join(spark, sf):
    return seeds.seeds_of(_sequences(spark, sf, "benchmark", "item_id", "query"), _sequences(spark, sf, "documents", "doc_id", "subject"), K)


@query(f"WITH {SEED_SQL} SELECT query, subject, s_pos - q_pos AS diagonal, count(*) AS seed_count, min(s_pos) AS s_from, max(s_pos) AS s_to FROM seeds GROUP BY ALL HAVING count(*) >= 3")
def diagonal_hits(spark, sf):
    return seeds.diagonal_hits(seed_join(spark, sf), SEEDS)


_LETTERS, _BASES = "abcdefghijklmnopqrstuvwxyz", ("ACGT" * 7)[:26]
_DNA = f"regexp_replace(translate(lower(text), '{_LETTERS}', '{_BASES}'), '[^ACGT]', '', 'g')"


@query(f"""WITH d AS (SELECT item_id, {_DNA} AS plus FROM benchmark), b AS (SELECT *, reverse(translate(plus, 'ACGT', 'TGCA')) AS minus FROM d),
    f AS (SELECT item_id, CAST(CASE WHEN s THEN -k ELSE k END AS INT) AS frame, substr(CASE WHEN s THEN minus ELSE plus END, k) AS dna FROM b, unnest([1, 2, 3]) u(k), unnest([false, true]) v(s)),
    c AS (SELECT item_id, frame, list_transform(range(0, length(dna) // 3), lambda i: substr('{seeds.AMINO}', 16 * (instr('TCAG', substr(dna, i * 3 + 1, 1)) - 1) + 4 * (instr('TCAG', substr(dna, i * 3 + 2, 1)) - 1) + instr('TCAG', substr(dna, i * 3 + 3, 1)), 1)) AS p FROM f)
    SELECT item_id, frame, coalesce(array_to_string(p, ''), '') AS protein FROM c""")
def six_frames(spark, sf):
    dna = F.regexp_replace(F.translate(F.lower("text"), _LETTERS, _BASES), "[^ACGT]", "")
    return seeds.six_frames(B.table(spark, sf, "benchmark").select("item_id", dna.alias("dna")), "item_id", "dna")


for _f, _sql in [*round_trips.ALL, *search.ALL]:
    query(_sql)(_f)
