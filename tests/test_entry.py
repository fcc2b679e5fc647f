"""The driver contract: entry smoke, registration, and Spark == DuckDB oracle."""

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracle import TABLES, rows_of
from tests.conftest import SF_SMALL

# the only registered queries without an oracle (none among the transit ones)
NO_ORACLE: set[str] = set()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["entity_id", "feed_timestamp", "feed_time", "route_long_name", "stop_name",
                          "speed", "speed_kmh"]


def test_every_query_has_an_oracle():
    transit = set(entry.queries()) - set(entry.LLM_QUERIES)
    assert transit - set(entry.oracle_sql()) == NO_ORACLE
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry.LLM_ORACLE_SQL)))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows_of(got) == rows_of(want)
