"""Every registered query against its SQL at the smallest scale; those without SQL must run."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract

QUERIES, SQL = contract.queries(), contract.oracle_sql()


def value(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(value, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck(data_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{data_dir}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')").fetchall()
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, data_dir, name):
    df = QUERIES[name](spark, data_dir)
    columns = sorted(df.columns)
    rows = sorted((tuple(value(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in SQL:
        return
    relation = duck.sql(SQL[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    assert rows == sorted((tuple(value(r[i]) for i in at) for r in relation.fetchall()), key=repr)


def test_entry(spark):
    assert contract.entry(spark).columns == ["snapshot_no", "licno", "change_kind"]


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)
