"""All registered queries against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from helixtable.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "nation customer supplier part orders lineitem events documents benchmark region"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def key(row):
    return tuple("" if v is None else f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else str(v) for v in row)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(name, spark, db):
    got = registry.QUERIES[name](spark, SF)
    want = db.sql(registry.ORACLES[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    order = [want.columns.index(c) for c in names]
    rows = sorted(key(r) for r in got.select(*[f"`{c}`" for c in names]).collect())
    assert rows == sorted(key([r[i] for i in order]) for r in want.fetchall())
    assert rows


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
