"""Every query against its SQL on the smallest tables, and what each must do on empty ones."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from compare import rows_of

ROOT = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    made = duckdb.connect()
    for path in glob.glob(f"{ROOT}/*.parquet"):
        made.execute(f"CREATE VIEW {os.path.basename(path)[: -len('.parquet')]} AS SELECT * FROM '{path}'")
    return made


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("empty")
    for path in glob.glob(f"{ROOT}/*.parquet"):
        spark.read.parquet(path).limit(0).write.parquet(f"{root}/{os.path.basename(path)}")
    return str(root)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    df = QUERIES[name](spark, ROOT)
    got = rows_of(df.columns, df.collect())
    assert len(set(df.columns)) == len(df.columns)
    if name in SQL:
        want = db.execute(SQL[name])
        columns = [c[0] for c in want.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == rows_of(columns, want.fetchall())


@pytest.mark.parametrize("name", QUERIES)
def test_query_on_empty_tables(spark, empty, name):
    assert len(QUERIES[name](spark, empty).collect()) in (0, 1, 20)  # totals are one row, the report has 20


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES)
