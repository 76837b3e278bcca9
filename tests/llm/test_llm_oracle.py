"""The SQL of this subpackage's queries against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", ["op1_decontamination", "op3_near_dedup", "op7_sharding", "op9_line_dedup", "op10_warc",
                                  "op11_fill_in_middle"])
def test_query_equals_sql(spark, db, name):
    import __spark_entry__ as entry
    got = entry.queries()[name](spark, SMALL)
    cols = sorted(got.columns)
    want = db.execute(entry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == cols
    rows = sorted((tuple(dict(zip(names, r, strict=True))[c] for c in cols) for r in want.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == rows
