"""Hits and domains derived from the star schema's tables, in Spark and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df dealt to all cores where its files make fewer partitions, for steps that cost much for each row; else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores // 2 else df


def hits(spark: SparkSession, sf_dir: str, dense: bool = False) -> DataFrame:
    """One hit for each line item. dense: fewer domains and chromosomes, so that many ranges overlap."""
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "part", "supplier", "nation")}
    rows = t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
    near = F.col("l_partkey") * 10
    far = near + F.col("l_quantity").cast("long") * 4
    plus = F.col("l_tax") < 0.04
    code = F.when(F.col("l_returnflag") == "A", "-").when(F.col("l_returnflag") == "R", "N").when(F.col("l_linestatus") == "O", "C").otherwise("NC")
    return rows.select(
        F.col("n_name").alias("species"),
        F.col("p_type" if dense else "p_brand").alias("domain"),
        code.alias("incomplete"),
        F.concat(F.lit("ref|NC_"), (F.col("l_suppkey") % 10 if dense else F.col("l_suppkey")).cast("string"), F.lit(".1|")).alias("chromosome"),
        F.when(plus, near).otherwise(far).alias("start_pos"),
        F.when(plus, far).otherwise(near).alias("end_pos"),
        (F.col("l_quantity") * 2.0).alias("bitscore"),
        (F.col("l_quantity") * 2.0).alias("pct_identity"),
        F.col("l_tax").alias("evalue"),
        (F.col("l_quantity").cast("int") * 2).alias("aln_len"),
        F.col("p_size"),
    )


def fine(df: DataFrame) -> DataFrame:
    """All hits under finer domains, few rows each, so that every kind of completeness occurs among them."""
    return df.withColumn("domain", F.concat("domain", F.lit("."), F.col("p_size").cast("string")))


HITS = """hits AS (
    SELECT n_name AS species, p_brand AS domain,
        CASE WHEN l_returnflag = 'A' THEN '-' WHEN l_returnflag = 'R' THEN 'N' WHEN l_linestatus = 'O' THEN 'C' ELSE 'NC' END AS incomplete,
        concat('ref|NC_', CAST(l_suppkey AS VARCHAR), '.1|') AS chromosome,
        CASE WHEN l_tax < 0.04 THEN l_partkey * 10 ELSE l_partkey * 10 + CAST(l_quantity AS BIGINT) * 4 END AS start_pos,
        CASE WHEN l_tax < 0.04 THEN l_partkey * 10 + CAST(l_quantity AS BIGINT) * 4 ELSE l_partkey * 10 END AS end_pos,
        l_quantity * 2.0 AS bitscore, l_quantity * 2.0 AS pct_identity, l_tax AS evalue, CAST(l_quantity AS INT) * 2 AS aln_len, p_size
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
)"""
FINE = HITS + ", cells AS (SELECT * REPLACE (concat(domain, '.', p_size) AS domain) FROM hits)"
NORMAL = HITS + """, normal AS (
    SELECT species, domain, incomplete, bitscore, nullif(regexp_extract(chromosome, '[A-Za-z]+_?[0-9]+[._]?[0-9]*', 0), '') AS chromosome,
        CASE WHEN start_pos < end_pos THEN '+' WHEN start_pos >= end_pos THEN '-' END AS strand,
        least(start_pos, end_pos) AS "start", greatest(start_pos, end_pos) AS "end"
    FROM hits
)"""
RANGES = NORMAL + """, reach AS (
    SELECT *, max("end") OVER (PARTITION BY species, domain, incomplete, chromosome, strand ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM normal
), islands AS (
    SELECT *, sum(CASE WHEN seen IS NULL OR "start" > seen + 1 THEN 1 ELSE 0 END) OVER
        (PARTITION BY species, domain, incomplete, chromosome, strand ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS island FROM reach
), ranges AS (
    SELECT species, domain, incomplete, chromosome, strand, min("start") AS "start", max("end") AS "end", max("end") - min("start") + 1 AS width,
        avg(bitscore) AS mean_bitscore, count(*) AS members
    FROM islands GROUP BY species, domain, incomplete, chromosome, strand, island
)"""
CONTINGENCY = RANGES + """, counts AS (SELECT species, domain, incomplete, count(*) AS n FROM ranges GROUP BY ALL),
table_cells AS (
    SELECT s.species, d.domain, CASE c.code WHEN '-' THEN 'Complete' WHEN 'NC' THEN 'Bitruncated' WHEN 'N' THEN 'N-Truncated' ELSE 'C-Truncated' END AS incomplete, coalesce(n, 0) AS "count"
    FROM (SELECT DISTINCT species FROM ranges) s CROSS JOIN (SELECT DISTINCT domain FROM ranges) d CROSS JOIN (VALUES ('N'), ('C'), ('NC'), ('-')) c(code)
    LEFT JOIN counts k ON k.species = s.species AND k.domain = d.domain AND k.incomplete = c.code
)"""
COMPLETENESS = FINE + """, found AS (
    SELECT species, domain, CASE WHEN count(*) = count(bitscore) THEN avg(bitscore) END AS bitscore,
        CASE WHEN bool_or(incomplete = '-') THEN 'W' WHEN bool_or(incomplete = 'NC') THEN 'NC' WHEN bool_or(incomplete = 'N') AND bool_or(incomplete = 'C') THEN 'B'
            WHEN bool_and(coalesce(incomplete = 'N', false)) THEN 'N' WHEN bool_and(coalesce(incomplete = 'C', false)) THEN 'C' END AS incomplete
    FROM cells GROUP BY species, domain
), completeness AS (
    SELECT *, CASE WHEN incomplete = 'W' THEN 'Complete' WHEN incomplete IN ('N', 'C', 'B') THEN 'Truncated' WHEN incomplete = 'NC' THEN 'Bitruncated' END AS incomplete_desc FROM found
), grid AS (
    SELECT species, domain, bitscore, incomplete, incomplete_desc, CASE incomplete_desc WHEN 'Complete' THEN 1 WHEN 'Truncated' THEN 2 WHEN 'Bitruncated' THEN 3 END AS rank FROM completeness
    UNION ALL
    SELECT n_name, domain, CAST(0 AS DOUBLE), 'Z', 'No Hit', 4 FROM nation CROSS JOIN (SELECT DISTINCT domain FROM cells)
)"""
