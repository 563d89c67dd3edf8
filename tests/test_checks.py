"""A spread of the checks against their SQL oracles, and the shape of the plans."""

import re

import pytest

from checks import catalog, compare
from checks.panels import REGION, Panel

SF = "/root/testdata/sf0.001"
SPREAD = [
    "ffill_bfill", "finalise", "aqi_table", "features", "state_mean_ci", "monthly_median_aqi",
    "month_box", "category_pivot", "p99_trim", "kpis", "temporal_split", "ml_metrics",
]


@pytest.fixture(scope="module")
def con():
    return compare.oracle_connection(SF)


@pytest.mark.parametrize("name", SPREAD)
def test_oracle(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    assert compare.difference(df, con, catalog.ORACLES[name]) is None


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_exchange_by_station_from_raw_rows_to_features(spark):
    text = plan(Panel(spark, SF, "sensor").featured)
    final = text.split("== Initial Plan ==")[-1]
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)", final)
    hashed = [e for e in exchanges if e[0] == "hashpartitioning"]
    assert len(hashed) == 1 and hashed[0][1].startswith("StationId")
    assert "BroadcastHashJoin" in final
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "Python", "Pandas"):
        assert bad not in final


@pytest.mark.parametrize("name", ["state_summary", "month_box", "p99_trim", "aqi_histogram", "pollutant_violin"])
def test_no_cross_join_in_distributions(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_value_counts_are_computed_once(spark):
    df = catalog.QUERIES["state_summary"](spark, SF)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") <= 2 * 4 and "ReusedExchange" in final


def test_state_filter_reaches_the_dimension_scan(spark):
    text = plan(Panel(spark, SF, "sensor").in_states)
    assert re.search(r"PushedFilters: \[In\(r_name", text)
    assert set(REGION.states) == {"AFRICA", "AMERICA", "ASIA", "EUROPE"}
