"""Every registered query beside its SQL on the smallest tables."""

import datetime
import os
from pathlib import Path

import duckdb
import pytest

from weftline.plans import catalog

DATA = Path(os.environ.get("WEFTLINE_TESTDATA", "/root/testdata")) / "sf0.001"
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    out.execute("SET timezone = 'UTC'")
    for f in DATA.glob("*.parquet"):
        out.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return out


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, con, name):
    df = catalog.queries()[name](spark, str(DATA))
    names = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in names) for r in df.collect())
    if name not in catalog.oracle_sql():
        assert got
        return
    want = con.execute(catalog.oracle_sql()[name])
    have = [c[0] for c in want.description]
    assert sorted(have) == names
    assert got == sorted(tuple(plain(r[have.index(c)]) for c in names) for r in want.fetchall())
