"""Domain reports against a line-by-line reader, with files in many splits, and without a shuffle of lines."""

import random
from collections import Counter

import pytest

from helixtable.sources import readers as R

ROW = "1\tQ\tSpecific\t{0}\t1\t9\t1e-5\t50\tcd1\tdom\t-\t9"
KINDS = ["DATA", "SESSION\t1\tp\tv{0}\td\tm\t1", "SESSION\tshort", "QUERY\tQ{0}\tPeptide\t10\tdef", "QUERY\tcut", "DOMAINS", "ENDDOMAINS", ROW, ROW, " " + ROW + " ", "1\tshort", "ENDQUERY", "", "SITES"]


def lines_of(rng, n):
    out = []
    while len(out) < n:
        some = [rng.choice(KINDS)] if rng.random() < 0.4 else [KINDS[3], "DOMAINS", ROW, "ENDDOMAINS", "ENDQUERY"]
        out += [s.format(rng.randrange(1000)) for s in some]
    at = rng.randrange(5)
    return out[:at] + ["DATA"] + out[at:] if rng.random() < 0.9 else out


def read(lines):
    """query_id, pssm_id, version of rows, and the lines that cannot be used."""
    lines, good, bad = [x.strip(" \t\n\x0b\f\r") for x in lines], [], []
    seen = is_open = False
    session, query = [], []
    field = lambda p, i: p[i] if i < len(p) else ""
    for i, x in enumerate(lines):
        p, following = x.split("\t"), lines[i + 1] if i + 1 < len(lines) else None
        if not seen:
            seen = x == "DATA"
            continue
        session, query = (p if x.startswith("SESSION") else session), (p if x.startswith("QUERY") else query)
        inside, asks = is_open and not x.startswith("ENDDOMAINS"), x.startswith("QUERY")
        if (inside and len(p) < 12) or (asks and not inside and len(p) < 5) or (x.startswith("SESSION") and not inside and len(p) < 7):
            bad.append(x)
        elif inside or (asks and following != "DOMAINS"):
            good.append((field(p if inside else query, 1), field(p, 3) if inside else "", field(session, 3)))
        if x.startswith("ENDDOMAINS"):
            is_open = False
        elif x == "DOMAINS" and i and lines[i - 1].startswith("QUERY"):
            is_open = True
    return good, bad


@pytest.mark.parametrize("split", [90, 700, 1 << 27])
def test_random_reports(spark, tmp_path, split):
    rng, good, bad = random.Random(split), [], []
    for i in range(6):
        lines = lines_of(rng, rng.randrange(3, 60))
        (tmp_path / f"S{i}.out").write_text("\n".join(lines) + "\n")
        g, b = read(lines)
        good, bad = good + g, bad + b
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        rows, odd = R.read_domain_report(spark, str(tmp_path))
        assert Counter((r.query_id, r.pssm_id, r.version) for r in rows.collect()) == Counter(good)
        assert Counter(r.value for r in odd.collect()) == Counter(bad)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_no_line_is_shuffled(spark, tmp_path):
    (tmp_path / "S.out").write_text("DATA\nSESSION\t1\tp\tv\td\tm\t1\nQUERY\tQ\tPeptide\t10\tdef\n")
    for df in R.read_domain_report(spark, str(tmp_path)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
