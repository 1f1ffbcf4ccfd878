"""Every registered query with a SQL twin against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, family, key, norm

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def test_entry(spark):
    assert entry.entry(spark).count() == 3


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted([tuple(norm(r[c]) for c in cols) for r in df.collect()], key=key)
    rel = con.sql(entry.oracle_sql()[name])
    assert cols == sorted(rel.columns)
    types = {f.name: family(f.dataType.simpleString()) for f in df.schema.fields if "array" not in f.dataType.simpleString()}
    assert types == {c: family(str(t)) for c, t in zip(rel.columns, rel.types) if c in types}
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    want = sorted([tuple(norm(r[i]) for i in order) for r in rel.fetchall()], key=key)
    assert got == want
