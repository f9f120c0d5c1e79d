"""Queries that write a format from the tables to the shared folder and read it again; their SQL gives the rows written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixtable.operators import catalog, ranges
from helixtable.plans import binding as B
from helixtable.schemas import DOMAIN_FIELDS
from helixtable.scratch import shared_folder
from helixtable.sources import readers as R
from helixtable.sources import writers as W
from helixtable.sources.fasta_pieces import read_fasta_pieces
from helixtable.streaming.incremental import ingest_increment as ingest

S = F.lit


def _text(df: DataFrame, spark: SparkSession) -> str:
    """Lines of df(species, value) in a folder for each species."""
    path = shared_folder(spark)
    df.select("species", "value").write.partitionBy("species").text(path)
    return path


# -- FASTA

_SEQUENCE = "regexp_replace(text, '[^A-Za-z]', '', 'g')"


def read_fasta(spark, sf):
    docs = B.table(spark, sf, "documents")
    path = shared_folder(spark)
    header = F.concat(S("D"), F.col("doc_id").cast("string"), S(" from "), "source")
    W.write_fasta(docs.select(F.col("lang").alias("species"), header.alias("header"), F.regexp_replace("text", "[^A-Za-z]", "").alias("sequence")), path)
    return R.read_fasta(spark, path, "*.txt")


READ_FASTA = f"SELECT lang AS species, concat('D', doc_id) AS seq_id, concat('from ', source) AS description, {_SEQUENCE} AS sequence, CAST(length({_SEQUENCE}) AS BIGINT) AS length FROM documents"


PIECE, BEYOND = 700, 11


def fasta_pieces(spark, sf):
    """The same files line by line, in pieces that overlap."""
    docs = B.table(spark, sf, "documents")
    path = shared_folder(spark)
    W.write_fasta(docs.select(F.col("lang").alias("species"), F.concat(S("D"), F.col("doc_id").cast("string"), S(" from "), "source").alias("header"), F.regexp_replace("text", "[^A-Za-z]", "").alias("sequence")), path)
    return read_fasta_pieces(spark, path, PIECE, BEYOND, "*.txt").select("species", "seq_id", "description", "first", "sequence")


FASTA_PIECES = f"""WITH d AS (SELECT lang, doc_id, source, {_SEQUENCE} AS s FROM documents),
p AS (SELECT *, unnest(range(0, greatest(1, (length(s) + {PIECE - 1}) // {PIECE}))) AS i FROM d)
SELECT lang AS species, concat('D', doc_id) AS seq_id, concat('from ', source) AS description, i * {PIECE} + 1 AS "first", substr(s, i * {PIECE} + 1, {PIECE + BEYOND}) AS sequence FROM p"""


def write_fasta(spark, sf):
    """Lines of sequences as they are in the files."""
    docs = B.table(spark, sf, "documents").select(F.col("lang").alias("species"), F.col("doc_id").cast("string").alias("header"), F.regexp_replace("text", "[^A-Za-z]", "").alias("sequence"))
    path = shared_folder(spark)
    W.write_fasta(docs, path)
    lines = spark.read.text(path)
    return lines.groupBy("species").agg(F.count_if(F.col("value").startswith(">")).alias("records"), F.max(F.length("value")).cast("long").alias("longest"), F.sum(F.when(~F.col("value").startswith(">"), F.length("value"))).alias("letters"))


WRITE_FASTA = f"SELECT lang AS species, count(*) AS records, CAST(60 AS BIGINT) AS longest, CAST(sum(length({_SEQUENCE})) AS BIGINT) AS letters FROM documents GROUP BY lang"



def _odd_fasta(spark, sf) -> str:
    """FASTA of all documents, in which each 97th record has no identifier and identifiers repeat."""
    docs = B.table(spark, sf, "documents")
    path = shared_folder(spark)
    name = F.when(F.col("doc_id") % 97 == 0, "").otherwise(F.concat(S("D"), (F.col("doc_id") % 50).cast("string")))
    species = F.when(F.col("doc_id") % 97 == 0, F.col("lang")).otherwise(F.concat("lang", S("_"), "source"))
    W.write_fasta(docs.select(species.alias("species"), F.concat(name, S(" of "), "lang").alias("header"), F.regexp_replace("text", "[^A-Za-z]", "").alias("sequence")), path)
    return path


_RECORDS = """records AS (SELECT CASE WHEN doc_id % 97 = 0 THEN lang ELSE concat(lang, '_', source) END AS file, CASE WHEN doc_id % 97 = 0 THEN '' ELSE concat('D', doc_id % 50) END AS seq_id FROM documents),
quality AS (SELECT file, count(*) AS records, count(*) FILTER (WHERE seq_id = '') AS empty_ids, count(DISTINCT seq_id) AS distinct_ids, count(*) FILTER (WHERE seq_id = '') = 0 AS valid FROM records GROUP BY file),
twice AS (SELECT file, seq_id, count(*) AS n FROM records WHERE seq_id <> '' GROUP BY file, seq_id HAVING count(*) > 1)"""


def _records(spark, sf) -> DataFrame:
    return R.read_fasta(spark, _odd_fasta(spark, sf), "*.txt").select(F.col("species").alias("file"), "seq_id")


def fasta_quality(spark, sf):
    return catalog.fasta_quality(_records(spark, sf))


def fasta_duplicates(spark, sf):
    return catalog.duplicate_ids(_records(spark, sf))


def fasta_verdict(spark, sf):
    return catalog.fasta_verdict(_records(spark, sf))


VERDICT = f"WITH {_RECORDS} SELECT count(*) AS files, count(*) FILTER (WHERE NOT valid) AS unfit, count(*) FILTER (WHERE file IN (SELECT file FROM twice)) AS with_duplicates, bool_and(valid) AS all_valid FROM quality"


def species_from_files(spark, sf):
    """Species of the files that hold all documents, by their folders."""
    return R.species_from_files(spark, _odd_fasta(spark, sf), "*.txt")


# -- hit reports


def _hit_lines(spark, sf, rps: bool) -> DataFrame:
    """Lines with 12 and 13 fields and, for each 97th order, with 5."""
    t = {n: B.table(spark, sf, n) for n in ("lineitem", "supplier", "nation")}
    rows = t["lineitem"].join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
    text = lambda c: F.col(c).cast("string")
    whole = lambda c: F.col(c).cast("long").cast("string")
    fields = [F.concat(S("NP_"), text("l_orderkey"), S("|tag:ABC123" if rps else "")), F.concat(S("NC_"), text("l_partkey")), whole("l_quantity"), text("l_suppkey"), *[text("l_linenumber")] * 6, S("0.5"), whole("l_quantity")]
    last = F.when((F.col("l_linenumber") % 2 == 0) | S(rps), S("MKV-LLT*"))
    line = F.when(F.col("l_orderkey") % 97 == 0, F.concat_ws("\t", *fields[:5])).otherwise(F.concat_ws("\t", *fields, last))
    return rows.select(F.col("n_name").alias("species"), line.alias("value"))


def _hit_sql(rps: bool) -> str:
    last = "'MKV-LLT*'" if rps else "CASE WHEN l_linenumber % 2 = 0 THEN 'MKV-LLT*' END"
    return f"""SELECT concat('NP_', l_orderkey) AS query_id, {"'ABC123' AS tag, " if rps else ""}concat('NC_', l_partkey) AS subject_id, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS pct_identity,
        CAST(l_suppkey AS VARCHAR) AS aln_len, {", ".join(f"CAST(l_linenumber AS VARCHAR) AS {c}" for c in ("mismatches", "gap_openings", "q_start", "q_end", "s_start", "s_end"))},
        '0.5' AS evalue, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS bitscore, {last} AS {"subject_title" if rps else "subject_sequence"}, n_name AS species
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_orderkey % 97 <> 0"""


def read_blast_tab(spark, sf):
    return R.read_blast_tab(spark, _text(_hit_lines(spark, sf, False), spark))[0]


def read_rps_tab(spark, sf):
    return R.read_rps_tab(spark, _text(_hit_lines(spark, sf, True), spark))[0]


def quarantined_lines(spark, sf):
    return R.read_blast_tab(spark, _text(_hit_lines(spark, sf, False), spark))[1].select("species", "reason")


QUARANTINED = "SELECT n_name AS species, '5 fields' AS reason FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_orderkey % 97 = 0"

# -- domain reports: an order is a query, its lines are domains; the seventh line's row is cut short


#: Orders of a part of the reports, which a task writes, a file for each nation.
ORDERS_A_PART = 250_000


def _report(spark, sf) -> DataFrame:
    """species, part, place and text of the pieces of reports, in order: at least two reports for each nation, which differ in the version of their program.

    Orders and their lines are dealt to parts once, as numbers; a part holds whole orders, even ones or odd ones, and is a report of its own for each nation.
    """
    t = {n: B.table(spark, sf, n) for n in ("lineitem", "orders", "customer", "nation")}
    text = lambda c: F.col(c).cast("string")
    parts = 2 * -(-t["orders"].count() // (2 * ORDERS_A_PART))
    orders = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    of = lambda c: (F.pmod(F.xxhash64(c), F.lit(parts // 2)) * 2 + F.col(c) % 2).cast("int").alias("part")
    item = F.struct("l_partkey", "l_linenumber", F.col("l_quantity").cast("long").alias("quantity"), "l_suppkey", "l_returnflag")
    asked = orders.select(of("o_orderkey"), F.col("o_orderkey").alias("place"), F.col("n_name").alias("species"), F.col("o_custkey").alias("custkey"), F.lit(None).cast(t["lineitem"].select(item.alias("i")).schema["i"].dataType).alias("i"))
    lines = t["lineitem"].select(of("l_orderkey"), F.col("l_orderkey").alias("place"), F.lit(None).cast("string").alias("species"), F.lit(None).cast(orders.schema["o_custkey"].dataType).alias("custkey"), item.alias("i"))
    both = asked.unionByName(lines).repartition(parts, "part")
    both = both.groupBy("part", "place").agg(F.max("species").alias("species"), F.max("custkey").alias("custkey"), F.sort_array(F.collect_list("i")).alias("items"))  # an order has a handful of lines
    both = both.where("species IS NOT NULL").withColumn("first", F.row_number().over(Window.partitionBy("part", "species").orderBy("place")) == 1)
    query = F.concat(S("Q"), text("place"))
    code = lambda i: F.when(i["l_returnflag"] == "A", "-").when(i["l_returnflag"] == "R", "N").otherwise("NC")
    row = lambda i: F.concat_ws(
        "\t", S("1"), query, S("Specific"), i["l_partkey"].cast("string"), i["l_linenumber"].cast("string"), i["quantity"].cast("string"), S("1e-05"), i["l_suppkey"].cast("string"),
        F.concat(S("cd"), i["l_partkey"].cast("string")), F.concat(S("dom"), (i["l_suppkey"] % 50).cast("string")), code(i), F.when(i["l_linenumber"] == 7, "").otherwise(S("-")),
    )
    head = F.concat_ws("\t", S("QUERY"), query, S("Peptide"), text("custkey"), F.concat(S("NC_"), text("custkey"), S(".1:"), text("place"), S("-9|tag:AB12CD")))
    block = F.when(F.size("items") > 0, F.concat(S("DOMAINS\n"), F.array_join(F.transform("items", row), "\n"), S("\nENDDOMAINS\nSITES\nskipped\nENDSITES\n"))).otherwise("")
    session = F.concat(S("preface\nQUERY\tbefore\tdata\nDATA\nSESSION\t1\tRPSBLAST\t2."), (F.col("part") % 2).cast("string"), S("\tcdd\tBLOSUM62\t0.01\n"))
    return both.select("species", "part", "place", F.concat(F.when(F.col("first"), session).otherwise(""), head, S("\n"), block, S("ENDQUERY")).alias("value"))


def _report_files(spark, sf) -> str:
    path = shared_folder(spark)
    rows = _report(spark, sf).sortWithinPartitions("species", "part", "place")
    rows.select("species", "part", "value").write.partitionBy("species", "part").text(path)
    return path


_CONTEXT = """'1' AS session_ordinal, 'RPSBLAST' AS program, concat('2.', o_orderkey % 2) AS version, 'cdd' AS database, 'BLOSUM62' AS score_matrix, '0.01' AS evalue_threshold, concat('Q', o_orderkey) AS query_id,
    'Peptide' AS seq_type, CAST(o_custkey AS VARCHAR) AS seq_length, concat('NC_', o_custkey, '.1:', o_orderkey, '-9|tag:AB12CD') AS definition, concat('NC_', o_custkey, '.1') AS chromosome,
    CAST(o_orderkey AS VARCHAR) AS "start", '9' AS "end\""""
_BLANKS = ("hit_type", "pssm_id", '"from"', '"to"', "evalue", "bitscore", "accession", "domain", "incomplete", "superfamily_pssm_id")
_ORDERS = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
EMPTY_QUERIES = f"SELECT n_name AS species, {_CONTEXT}, {', '.join(f"'' AS {c}" for c in _BLANKS)}, 'AB12CD' AS tag FROM {_ORDERS} WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"
REPORT = f"""SELECT n_name AS species, {_CONTEXT}, 'Specific' AS hit_type, CAST(l_partkey AS VARCHAR) AS pssm_id, CAST(l_linenumber AS VARCHAR) AS "from", CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS "to",
    '1e-05' AS evalue, CAST(l_suppkey AS VARCHAR) AS bitscore, concat('cd', l_partkey) AS accession, concat('dom', l_suppkey % 50) AS domain,
    CASE l_returnflag WHEN 'A' THEN '-' WHEN 'R' THEN 'N' ELSE 'NC' END AS incomplete, '-' AS superfamily_pssm_id, 'AB12CD' AS tag
FROM lineitem JOIN {_ORDERS.replace('orders JOIN', 'orders ON l_orderkey = o_orderkey JOIN')} WHERE l_linenumber <> 7 UNION ALL {EMPTY_QUERIES}"""


def read_domain_report(spark, sf):
    return R.read_domain_report(spark, _report_files(spark, sf))[0]


def queries_without_domains(spark, sf):
    return read_domain_report(spark, sf).where("domain = ''")


def _intake(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Domains and unusable lines of reports taken in by two runs of the stream, the second with nothing new."""
    reports, table, odd, checkpoint = _report_files(spark, sf), shared_folder(spark), shared_folder(spark), shared_folder(spark)
    for _ in range(2):
        ingest(spark, reports, table, checkpoint, odd)
    return spark.read.parquet(table).drop("batch"), spark.read.parquet(odd).drop("batch")


def ingest_increment(spark, sf):
    return _intake(spark, sf)[0]


def ingest_quarantine(spark, sf):
    return _intake(spark, sf)[1]


INGEST_QUARANTINE = """SELECT n_name AS species, '11 fields' AS reason, concat_ws(chr(9), '1', concat('Q', l_orderkey), 'Specific', l_partkey, l_linenumber, CAST(l_quantity AS BIGINT), '1e-05', l_suppkey,
        concat('cd', l_partkey), concat('dom', l_suppkey % 50), CASE l_returnflag WHEN 'A' THEN '-' WHEN 'R' THEN 'N' ELSE 'NC' END) AS value
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE l_linenumber = 7"""


# -- tables


def _cells(spark, sf) -> DataFrame:
    return B.hits(spark, sf).select("species", "domain", "incomplete", "start_pos", "bitscore")


CELLS = f"WITH {B.HITS} SELECT species, domain, incomplete, start_pos, bitscore FROM hits"


def write_parquet(spark, sf):
    path = shared_folder(spark)
    W.write_parquet(_cells(spark, sf), path)
    return spark.read.parquet(path)


def split_by_species(spark, sf):
    """Rows of each species and how many of them lie in the species' own folder."""
    path = shared_folder(spark)
    W.write_parquet(_cells(spark, sf), path)
    own = F.col("_metadata.file_path").contains(F.concat(S("/species="), "species", S("/")))
    return spark.read.parquet(path).select("species", own.alias("own")).groupBy("species").agg(F.count(S(1)).alias("rows"), F.count_if("own").alias("in_folder"))


def union_species(spark, sf):
    """The tables of all listed species as one, where some species have no folder, as their runs gave nothing."""
    path = shared_folder(spark)
    W.write_parquet(_cells(spark, sf).where(~F.col("species").endswith("7")), path)
    return R.union_species(spark, path, B.table(spark, sf, "nation").selectExpr("n_name AS species"))


def write_csv(spark, sf):
    path = shared_folder(spark)
    W.write_csv(_cells(spark, sf), path)
    return spark.read.schema(_cells(spark, sf).schema).csv(path, header=True)


def write_tsv(spark, sf):
    path = shared_folder(spark)
    W.write_tsv(read_domain_report(spark, sf), path)
    return spark.read.option("sep", "\t").schema(", ".join(f"`{c}` string" for c in DOMAIN_FIELDS)).csv(path, header=True).na.fill("")


WRITE_TSV = f"SELECT {', '.join(f'"{c}"' for c in DOMAIN_FIELDS)} FROM ({REPORT})"


def write_csv2(spark, sf):
    path = shared_folder(spark)
    W.write_csv2(_cells(spark, sf), path)
    return spark.read.option("sep", ";").csv(path, header=True).withColumn("start_pos", F.col("start_pos").cast("long"))


CSV2 = f"WITH {B.HITS} SELECT species, domain, incomplete, start_pos, replace(CAST(bitscore AS VARCHAR), '.', ',') AS bitscore FROM hits"


def write_gff3(spark, sf):
    path = shared_folder(spark)
    W.write_gff3(ranges.reduce_ranges(ranges.normalize(B.hits(spark, sf))), path)
    return spark.read.text(path).select("species", "value")


GFF3 = f"""WITH {B.RANGES} SELECT species, concat_ws(chr(9), chromosome, 'helixtable', 'sequence_feature', "start", "end", '.', strand, '.',
        concat('species=', species, ';domain=', domain, ';incomplete=', incomplete, ';mean_bitscore=', CAST(mean_bitscore AS VARCHAR))) AS value FROM ranges
    UNION ALL SELECT DISTINCT species, '##gff-version 3' FROM ranges"""


def append_provenance(spark, sf):
    """Two appends to one log."""
    path = shared_folder(spark)
    log = B.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("query"), F.concat(S("GCF_"), F.col("o_orderkey").cast("string")).alias("accession"), F.col("o_orderpriority").alias("level"))
    W.append_provenance(log.where("level = '5-LOW'"), path)
    W.append_provenance(log.where("level <> '5-LOW'"), path)
    return spark.read.option("sep", "\t").schema("query string, accession string, level string").csv(path)


PROVENANCE = "SELECT CAST(o_custkey AS VARCHAR) AS query, concat('GCF_', o_orderkey) AS accession, o_orderpriority AS level FROM orders"


def species_present(spark, sf):
    path = shared_folder(spark)
    W.write_csv(_cells(spark, sf), path)
    return R.species_present(spark, path, B.table(spark, sf, "nation").selectExpr("n_name AS species"))


def species_list(spark, sf):
    """Names of a text file that has blank lines too."""
    path = shared_folder(spark)
    B.table(spark, sf, "nation").select(F.explode(F.array("n_name", S(""))).alias("value")).write.text(path)
    return R.species_from_lines(spark, path)


def _summaries(spark, sf) -> DataFrame:
    """taxon and the JSON summary of the orders of a nation's customers, as reports in the order of their keys."""
    rows = B.table(spark, sf, "orders").join(B.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(B.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    grouped = rows.groupBy(F.col("n_name").alias("taxon")).agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("rs"))
    reports = F.transform("rs", lambda r: F.struct(F.concat(S("GCF_"), r["o_orderkey"].cast("string")).alias("accession"), F.struct(r["o_orderpriority"].alias("assembly_level")).alias("assembly_info")))
    return grouped.select("taxon", F.to_json(F.struct(reports.alias("reports"))).alias("json"))


def scan_assembly_json(spark, sf):
    return R.parse_assembly_json(_summaries(spark, sf))


def read_assembly_json(spark, sf):
    """The same summaries, each written to a file of its own."""
    path = shared_folder(spark)
    _summaries(spark, sf).select("taxon", F.col("json").alias("value")).write.partitionBy("taxon").text(path)
    return R.read_assembly_json(spark, path)


ASSEMBLIES = """SELECT n_name AS taxon, CAST(row_number() OVER (PARTITION BY n_name ORDER BY o_orderkey) - 1 AS INT) AS report_index, concat('GCF_', o_orderkey) AS accession, o_orderpriority AS level
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

ALL = [
    (read_fasta, READ_FASTA),
    (fasta_pieces, FASTA_PIECES),
    (write_fasta, WRITE_FASTA),
    (read_blast_tab, _hit_sql(False)),
    (read_rps_tab, _hit_sql(True)),
    (quarantined_lines, QUARANTINED),
    (read_domain_report, REPORT),
    (queries_without_domains, EMPTY_QUERIES),
    (ingest_increment, REPORT),
    (ingest_quarantine, INGEST_QUARANTINE),
    (fasta_quality, f"WITH {_RECORDS} SELECT * FROM quality"),
    (fasta_duplicates, f"WITH {_RECORDS} SELECT * FROM twice"),
    (fasta_verdict, VERDICT),
    (species_from_files, f"WITH {_RECORDS} SELECT DISTINCT file AS species FROM records"),
    (write_parquet, CELLS),
    (split_by_species, f"WITH {B.HITS} SELECT species, count(*) AS rows, count(*) AS in_folder FROM hits GROUP BY species"),
    (union_species, CELLS + " WHERE species NOT LIKE '%7'"),
    (write_csv, CELLS),
    (write_tsv, WRITE_TSV),
    (write_csv2, CSV2),
    (write_gff3, GFF3),
    (append_provenance, PROVENANCE),
    (species_present, f"WITH {B.HITS} SELECT DISTINCT species FROM hits"),
    (species_list, "SELECT n_name AS species FROM nation"),
    (scan_assembly_json, ASSEMBLIES),
    (read_assembly_json, ASSEMBLIES),
]
