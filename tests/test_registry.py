import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, normal

SF = "/root/testdata/sf0.001"
SAMPLE = ["curate_trips", "kpi_zone_summary", "trips_per_weekday", "normalize_grid", "flag_late", "segments",
          "demand_supply_30s", "features_timelag", "match_nearest"]


def test_every_sql_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 16


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = normal(entry.queries()[name](spark, SF).toPandas())
    assert got.equals(normal(con.execute(entry.oracle_sql()[name]).df()))
