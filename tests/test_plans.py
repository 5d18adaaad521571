"""Shapes of physical plans that matter at scale."""

import pytest

from hangarflow import bindings as B, rules
from hangarflow.operators import cleaning, gold, windows
from hangarflow.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["kpi_summary", "outlier_iqr", "cleaning_log", "inv_aircraft", "scd2_pit", "asof_since", "inv_recommend", "fleet_join", "drift_psi", "drift_ks"])
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scaling_reads_the_split_once(spark):
    assert plan(QUERIES["scale"](spark, SF)).count("Scan parquet") <= 16


def test_feature_windows_share_one_exchange(spark):
    wide = B.daily_wide(spark, SF)
    base = plan(wide).count("Exchange hashpartitioning")
    assert plan(gold.daily_features(wide)).count("Exchange hashpartitioning") == base + 1
    assert plan(windows.anomaly(windows.trend(windows.rolling(wide, rules.SENSORS), rules.SENSORS), rules.SENSORS)).count("Exchange") <= base + 3


def test_scan_reads_only_what_it_needs(spark):
    text = plan(B.failures(spark, SF).select("aircraft_id", "failure_ts"))
    schema = text.split("ReadSchema:")[1]
    assert "props" not in schema
    assert "PushedFilters: [" in text and "GreaterThanOrEqual(value,100" in text


def test_no_python_in_the_data_path(spark):
    for name in ("gold_daily", "silver_readings", "hourly_features", "aircraft_features", "kpi_summary", "smote"):
        text = plan(QUERIES[name](spark, SF))
        assert "Python" not in text and "Pandas" not in text


def test_dedup_combines_before_the_shuffle(spark):
    line = B.table(spark, SF, "lineitem")
    text = plan(cleaning.keep_first(line, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"]))
    assert "partial_min_by" in text
