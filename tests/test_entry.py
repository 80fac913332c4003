"""Driver contract; queries equal DuckDB even in a non-UTC session."""

import duckdb
import pytest

import __spark_entry__ as E
from quaystat.plans.oracle import ORACLE
from quaystat.plans.registry import QUERIES
from quaystat.sources.testdata import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    modes = spark.read.parquet(f"{SF}/events.parquet").selectExpr("(user_id div 5) % 5 AS m").distinct().count()
    assert df.count() == modes
    assert "average_delay_seconds" in df.columns


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES) and set(ORACLE) <= set(E.oracle_sql()) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", ["latest_estimate", "delay_by_hour", "flatten_snapshots", "dim_date", "quality_by_mode", "parse_instants", "etl_silver", "key_duplicates_found"])
def test_query_matches_oracle_in_new_york_session(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    expected = sorted(map(repr, res.fetchall()))
    got = sorted(map(repr, (tuple(r[c] for c in ocols) for r in E.queries()[name](spark, SF).collect())))
    assert got == expected
