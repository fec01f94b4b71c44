import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__
from tidewright.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return str(v)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    rows = lambda found, columns: sorted((tuple(plain(r[columns.index(c)]) for c in names) for r in found), key=repr)
    assert rows([tuple(r) for r in got.collect()], got.columns) == rows(want.fetchall(), want.columns)


def test_clusters_hold_every_curve(spark):
    rows = QUERIES["curve_clusters"](spark, SF).collect()
    assert len(rows) == 25 and len({r.cluster_id for r in rows}) == 4


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0 and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
