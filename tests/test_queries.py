"""Every registered query against its SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import TABLES, rows_of

@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and {r.split for r in rows} == {"train", "val", "test"}


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = entry.queries()[name](spark, sf_dir)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cursor.fetchall())
