"""Every registered query of the engine against DuckDB on the shared tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__
from marginalia.plans import catalogue

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not glob.glob(f"{FOLDER}/*.parquet"), reason="no shared tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return c


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def same(spark, duck, query, statement):
    df = query(spark, FOLDER)
    got = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    found = duck.execute(statement)
    names = [d[0] for d in found.description]
    at = sorted(range(len(names)), key=lambda i: names[i])
    assert sorted(names) == sorted(df.columns)
    assert ordered(got) == ordered([tuple(r[i] for i in at) for r in found.fetchall()])


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query(spark, duck, name):
    same(spark, duck, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name])


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
