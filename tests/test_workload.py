"""Every registered query against its SQL, at the smallest scale and with one hot device."""

import duckdb
import pytest
from check import TABLES, differences

import __spark_entry__ as contract
from wattloom.workload import QUERIES

FOLDER = "/root/testdata/sf0.001"


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def small():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    """Every third event moves to device 7, and every third order to customer 7."""
    folder = tmp_path_factory.mktemp("hot")
    con = connect(FOLDER)
    change = {
        "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id) FROM events",
        "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey) FROM orders",
    }
    for name in TABLES:
        con.execute(f"COPY ({change.get(name, f'SELECT * FROM {name}')}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder), connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, small, name):
    df = contract.queries()[name](spark, FOLDER)
    assert differences(df.toPandas(), small.sql(contract.oracle_sql()[name]).df()) == []


HOT = [
    "solar_fact_15m", "battery_fact_15m", "as_of_join", "upsample_linear", "latest_state", "last_per_bucket",
    "solar_generation", "orphan_keys", "dim_battery", "left_join_current", "stream_tumbling_15m",
]


@pytest.mark.parametrize("name", HOT)
def test_query_agrees_with_a_hot_device(spark, hot, name):
    folder, con = hot
    df = contract.queries()[name](spark, folder)
    assert differences(df.toPandas(), con.sql(contract.oracle_sql()[name]).df()) == []


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["solar_panel_key", "date_key", "solar_panel_id", "generation_power_wh"]
    assert df.count() > 0
