"""Every query of the core against its SQL over the smallest tables, and what the entry points promise."""

import os
from collections import Counter

import pytest

import __spark_entry__ as entry

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(ROOT), reason="no test data")
QUERIES, SQL = entry.queries(), entry.oracle_sql()
CORE = [n for n in QUERIES if "llm" not in QUERIES[n].__module__]


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(ROOT):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{ROOT}/{f}'")
    return con


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool):
        return v
    return round(float(v), 6) if isinstance(v, (int, float)) or type(v).__name__ == "Decimal" else str(v)


@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, ROOT)
    rows = df.collect()
    if name not in SQL:
        assert df.columns
        return
    found = duck.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    want = Counter(tuple(plain(r[columns.index(c)]) for c in df.columns) for r in found.fetchall())
    assert Counter(tuple(plain(v) for v in r) for r in rows) == want


def test_entry(spark):
    assert len(entry.entry(spark).select("impact_id").collect()) == 6


def test_oracles_have_queries():
    assert set(SQL) <= set(QUERIES)
