"""Every registered query against its DuckDB text at the smallest scale."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_queries import TABLES, canonical

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_texts_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    got = queries()[name](spark, FOLDER).toPandas()
    if name not in oracle_sql():
        assert len(got)
        return
    want = duck.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)
