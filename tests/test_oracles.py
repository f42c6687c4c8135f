"""Every registered query against its SQL, on the smallest tables."""

import decimal
import os

import duckdb
import pytest

from advisorium import catalog

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return repr(round(float(v), 6) + 0.0)
    return str(bool(v)) if isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = db.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert got == want


def test_stream_alert_equals_batch(spark):
    one, two = (sorted(map(tuple, catalog.QUERIES[n](spark, DATA).collect())) for n in ("alert_runs", "stream_alert"))
    assert one == two


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and catalog.FLAGSHIP in catalog.QUERIES
