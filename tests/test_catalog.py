"""Every catalogue query against its SQL in DuckDB on the same tables."""

import glob
import math
from pathlib import Path

import duckdb
import pytest

from quillspan.plans import catalog

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(p).stem} AS SELECT * FROM '{p}'")
    return con


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    got = df.collect()
    rel = db.execute(catalog.ORACLES[name])
    cols = [c[0] for c in rel.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(cols)
    want = sorted((tuple(canon(r[cols.index(c)]) for c in order) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(canon(r[c]) for c in order) for r in got), key=repr) == want
    assert got
