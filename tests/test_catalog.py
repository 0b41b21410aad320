"""Every registered query against its SQL, run by DuckDB on the same files."""

import datetime as dt
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from lookfuse.catalog import QUERIES

FOLDER = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        return v.isoformat(sep=" ") if isinstance(v, (dt.date, dt.datetime)) else v

    return [names[i] for i in order], sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = entry.queries()[name](spark, FOLDER)
    got = comparable(result.columns, result.collect())
    answer = duck.execute(entry.oracle_sql()[name])
    want = comparable([d[0] for d in answer.description], answer.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
