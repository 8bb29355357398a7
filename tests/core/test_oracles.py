"""Registered queries against their SQL, over the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver tables")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    show = lambda v: repr(round(v, 5)) if isinstance(v, float) else str(v)
    return sorted(tuple(show(r[k]) for k in order) for r in rows)


def names():
    from modlake.plans.registry import ORACLES

    return sorted(ORACLES)


@pytest.mark.parametrize("name", names())
def test_query_equals_its_sql(spark, db, name):
    from modlake.plans.registry import ORACLES, QUERIES

    got = QUERIES[name](spark, DATA)
    want = db.sql(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.columns, got.collect()) == rows_of(columns, want.fetchall())


def test_entry_point():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
