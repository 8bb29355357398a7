import datetime
from pathlib import Path

import duckdb
import pytest

from modlake.llm.queries import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")


def plain(x):
    return round(x, 6) if isinstance(x, float) else x.isoformat() if isinstance(x, datetime.datetime) else x


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        db.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = db.sql(ORACLES[name])
    columns = sorted(want.columns)
    rows = lambda names, found: sorted((tuple(plain(dict(zip(names, r))[c]) for c in columns) for r in found), key=str)
    got = QUERIES[name](spark, str(DATA))
    assert sorted(got.columns) == columns
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())
