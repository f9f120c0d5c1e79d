"""Queries of the similarity search: benchmark passages in documents as letters, and as proteins in genomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtable.operators import extension as E
from helixtable.operators import seeds as S
from helixtable.operators import translated as T
from helixtable.plans import binding as B
from helixtable.scratch import kept

K, K_PROTEIN, DROP = 12, 6, 20
LETTERS, BASES = "abcdefghijklmnopqrstuvwxyz", ("ACGT" * 7)[:26]
IDENTITY = dict(identity=60.0, length=50, score=70)


def _texts(spark, sf, name, key, as_id, sequence=None) -> DataFrame:
    return B.spread(B.table(spark, sf, name).select(key, "text")).select(F.col(key).alias(as_id), (F.col("text") if sequence is None else sequence).alias("sequence"))


def extended_hits(spark, sf):
    q, s = _texts(spark, sf, "benchmark", "item_id", "query"), _texts(spark, sf, "documents", "doc_id", "subject")
    return E.extend_seeds(S.seeds_of(q, s, K), q, E.blocks_of(s), K, drop=DROP)


def identity_hits(spark, sf):
    return E.within(extended_hits(spark, sf), **IDENTITY)


def _dna():
    return F.regexp_replace(F.translate(F.lower("text"), LETTERS, BASES), "[^ACGT]", "")


def translated_hits(spark, sf):
    """Passages, of which every other one is translated from its reverse complement, in all documents as genomes."""
    protein = F.when(F.col("item_id") % 2 == 0, S.amino(_dna(), 0)).otherwise(S.amino(S.reverse_complement(_dna()), 0))
    q = _texts(spark, sf, "benchmark", "item_id", "query", protein)
    genomes = kept(S.chunked(_texts(spark, sf, "documents", "doc_id", "subject", _dna()), E.WIDTH, T.overlap(K_PROTEIN), "subject"))
    return E.within(T.translated_search(q, genomes, K_PROTEIN, drop=DROP), length=30)


def _extension(k: int, score: str) -> str:
    """Steps from seeds(query, subject, q_pos, s_pos), q(query, a) and s(subject, b) to hits, position by position."""
    key = "query, subject, d, run"
    return f"""diagonals AS (SELECT *, s_pos - q_pos AS d FROM seeds),
marked AS (SELECT *, CASE WHEN coalesce(q_pos > lag(q_pos) OVER (PARTITION BY query, subject, d ORDER BY q_pos) + {k}, true) THEN 1 ELSE 0 END AS new FROM diagonals),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY query, subject, d ORDER BY q_pos) AS run FROM marked),
runs AS (SELECT {key}, min(q_pos) AS qf, max(q_pos) + {k - 1} AS qt, count(*) AS n FROM numbered GROUP BY {key}),
cut AS (SELECT runs.*, a, substr(b, greatest(d, 0) + 1, length(a)) AS b, least(d, 0) AS shift FROM runs JOIN q USING (query) JOIN s USING (subject)),
sides AS (
    SELECT *, 1 AS side, least(length(a), length(b) - shift) - qt AS most FROM cut
    UNION ALL SELECT *, -1, qf - greatest(1, 1 - shift) FROM cut
), steps AS (
    SELECT {key}, side, i, substr(a, CASE side WHEN 1 THEN qt + i ELSE qf - i END, 1) AS x, substr(b, shift + CASE side WHEN 1 THEN qt + i ELSE qf - i END, 1) AS y
    FROM sides, unnest(range(1, CAST(most AS BIGINT) + 1)) u(i)
), sums AS (SELECT *, sum({score}) OVER (PARTITION BY {key}, side ORDER BY i) AS c FROM steps),
tops AS (SELECT *, greatest(0, max(c) OVER (PARTITION BY {key}, side ORDER BY i)) AS top FROM sums),
ends AS (SELECT {key}, side, coalesce(min(i) FILTER (WHERE top - c > {DROP}), 1000000000) AS dead FROM tops GROUP BY {key}, side),
bests AS (SELECT {key}, side, max({{'c': c, 'i': -i}}) AS best FROM tops JOIN ends USING ({key}, side) WHERE i < dead AND c > 0 GROUP BY {key}, side),
grown AS (
    SELECT cut.*, qf + coalesce(l.best.i, 0) AS q_start, qt - coalesce(r.best.i, 0) AS q_end, 5 * (qt - qf + 1) + coalesce(l.best.c, 0) + coalesce(r.best.c, 0) AS score
    FROM cut LEFT JOIN (SELECT * FROM bests WHERE side = -1) l USING ({key}) LEFT JOIN (SELECT * FROM bests WHERE side = 1) r USING ({key})
), reached AS (
    SELECT *, coalesce(max(q_end) OVER (PARTITION BY query, subject, d ORDER BY q_start, q_end DESC, qf ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < q_end, true) AS own FROM grown
), grouped AS (SELECT *, sum(own::INT) OVER (PARTITION BY query, subject, d ORDER BY q_start, q_end DESC, qf) AS hit FROM reached),
summed AS (SELECT *, sum(n) OVER (PARTITION BY query, subject, d, hit) AS seed_count FROM grouped),
hits AS (
    SELECT query, subject, d, CAST(q_start AS BIGINT) AS q_start, CAST(q_end AS BIGINT) AS q_end, CAST(q_end - q_start + 1 AS BIGINT) AS aln_len,
        CAST(len(list_filter(range(CAST(q_start AS BIGINT), CAST(q_end AS BIGINT) + 1), lambda r: substr(a, r, 1) = substr(b, r + shift, 1))) AS BIGINT) AS matches,
        CAST(score AS BIGINT) AS score, CAST(seed_count AS BIGINT) AS seed_count, substr(b, CAST(q_start + shift AS BIGINT), CAST(q_end - q_start + 1 AS BIGINT)) AS subject_sequence
    FROM summed WHERE own
), scored AS (SELECT *, aln_len - matches AS mismatches, CAST(matches AS DOUBLE) * 100 / aln_len AS pct_identity FROM hits)"""


_SEEDS = f"""q AS (SELECT item_id AS query, text AS a FROM benchmark), s AS (SELECT doc_id AS subject, text AS b FROM documents),
qk AS (SELECT query, substr(a, i, {K}) AS kmer, i AS q_pos FROM (SELECT query, a, unnest(range(1, length(a) - {K - 2})) AS i FROM q)),
sk AS (SELECT subject, substr(b, i, {K}) AS kmer, i AS s_pos FROM (SELECT subject, b, unnest(range(1, length(b) - {K - 2})) AS i FROM s)),
seeds AS (SELECT query, q_pos, subject, s_pos FROM qk JOIN sk USING (kmer))"""
_PLAIN = f"WITH {_SEEDS}, {_extension(K, 'CASE WHEN x = y THEN 5 ELSE -4 END')}"
_COLUMNS = "query, subject, q_start, q_end, q_start + d AS s_start, q_end + d AS s_end, aln_len, matches, mismatches, pct_identity, score, seed_count, subject_sequence"
EXTENDED = f"{_PLAIN} SELECT {_COLUMNS} FROM scored"
_THRESHOLDS = "pct_identity >= 60 AND score >= 70"

_SQL_DNA = f"regexp_replace(translate(lower(text), '{LETTERS}', '{BASES}'), '[^ACGT]', '', 'g')"
_CODON = f"substr('{S.AMINO}', 16 * (instr('TCAG', substr(dna, i * 3 + 1, 1)) - 1) + 4 * (instr('TCAG', substr(dna, i * 3 + 2, 1)) - 1) + instr('TCAG', substr(dna, i * 3 + 3, 1)), 1)"
_PROTEIN = f"coalesce(array_to_string(list_transform(range(0, length(dna) // 3), lambda i: {_CODON}), ''), '')"
_HEADS = "".join(c[0] * len(c) for c in E.PROTEIN.classes)
_ALIKE = " = ".join(f"translate({c}, '{''.join(E.PROTEIN.classes)}', '{_HEADS}')" for c in "xy")
TRANSLATED = f"""WITH passages AS (SELECT item_id AS query, CASE WHEN item_id % 2 = 0 THEN d ELSE reverse(translate(d, 'ACGT', 'TGCA')) END AS dna FROM (SELECT item_id, {_SQL_DNA} AS d FROM benchmark)),
q AS (SELECT query, {_PROTEIN} AS a FROM passages),
genomes AS (SELECT doc_id, {_SQL_DNA} AS plus FROM documents),
frames AS (
    SELECT doc_id, strand, f, length(plus) AS n, substr(CASE strand WHEN '+' THEN plus ELSE reverse(translate(plus, 'ACGT', 'TGCA')) END, f) AS dna
    FROM genomes, unnest(['+', '-']) t(strand), unnest([1, 2, 3]) u(f)
), s AS (SELECT concat(doc_id, strand, f) AS subject, doc_id, strand, f, n, {_PROTEIN} AS b FROM frames),
qk AS (SELECT query, substr(a, i, {K_PROTEIN}) AS kmer, i AS q_pos FROM (SELECT query, a, unnest(range(1, length(a) - {K_PROTEIN - 2})) AS i FROM q)),
sk AS (SELECT subject, substr(b, i, {K_PROTEIN}) AS kmer, i AS s_pos FROM (SELECT subject, b, unnest(range(1, length(b) - {K_PROTEIN - 2})) AS i FROM s)),
seeds AS (SELECT query, q_pos, subject, s_pos FROM qk JOIN sk USING (kmer)),
{_extension(K_PROTEIN, f'CASE WHEN x = y THEN 5 WHEN {_ALIKE} THEN 1 ELSE -4 END')}
SELECT query, doc_id AS subject, strand, q_start, q_end, CASE strand WHEN '+' THEN f + 3 * (q_start + d - 1) ELSE n - f + 1 - 3 * (q_start + d - 1) END AS s_start,
    CASE strand WHEN '+' THEN f + 3 * (q_end + d - 1) + 2 ELSE n - f + 1 - 3 * (q_end + d - 1) - 2 END AS s_end,
    aln_len, matches, mismatches, pct_identity, score, seed_count, subject_sequence
FROM scored JOIN s USING (subject) WHERE {_THRESHOLDS} AND aln_len >= 30"""

ALL = [
    (extended_hits, EXTENDED),
    (identity_hits, f"{EXTENDED} WHERE {_THRESHOLDS} AND aln_len >= 50"),
    (translated_hits, TRANSLATED),
]
