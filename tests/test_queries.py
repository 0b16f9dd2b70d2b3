"""Every registered query against its SQL twin at the smallest scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import canon

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def test_only_seeded_draws_lack_sql():
    own = {n for n in QUERIES if n != "pipeline" and not n.startswith("op")}
    assert own - set(SQL) == {"windows_random", "random_codes"}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n != "pipeline" and not n.startswith("op")))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    order = sorted(df.columns)
    got = sorted(tuple(canon(r[c]) for c in order) for r in df.collect())
    assert got
    if name in SQL:
        cur = con.execute(SQL[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == order
        at = [names.index(c) for c in order]
        assert got == sorted(tuple(canon(r[i]) for i in at) for r in cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
