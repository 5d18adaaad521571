"""Sliding medians: against brute force, against time, and the plan."""

import datetime as dt
import random
import statistics
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from hangarflow.operators import cleaning, moving

SCHEMA = "id long, sensor_id string, measurement_timestamp timestamp, measurement_value double"


@pytest.mark.parametrize("n, distinct", [(1, 1), (2, 2), (60, 3), (300, 300)])
def test_frames(n, distinct):
    rng = np.random.default_rng(n)
    v = rng.choice(rng.normal(size=distinct), n)
    low = rng.integers(0, n + 1, 200)
    high = np.minimum(n, low + rng.integers(0, n + 1, 200))
    got = moving.medians_of_frames(v, low, high)
    for a, b, m in zip(low, high, got):
        assert np.isnan(m) if a == b else m == pytest.approx(np.median(v[a:b]))
    for k in range(3):
        some = high - low > k
        got = moving.kth_of_frames(v, low[some], high[some], np.full(some.sum(), k))
        assert list(got) == [np.sort(v[a:b])[k] for a, b in zip(low[some], high[some])]


def brute(rows, hours=24):
    out = {}
    for i, s, t, v in rows:
        near = [x for _, o, u, x in rows if o == s and x is not None and t - dt.timedelta(hours=hours) <= u < t]
        if v is None and near:
            out[i] = statistics.median(near)
    return out


def test_medians_across_chunks(spark):
    """Frames that begin exactly at a reading, readings at the asked time, chunk borders, ties, several sensors."""
    rng = random.Random(2)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        t = t0 + dt.timedelta(hours=rng.choice([rng.randrange(0, 100), rng.uniform(0, 100), 24, 48, 72]))
        rows.append((i, rng.choice("ab"), t, None if rng.random() < 0.4 else float(rng.randrange(9))))
    df = spark.createDataFrame(rows, SCHEMA)
    asks = df.where("measurement_value IS NULL")
    got = moving.trailing_median(df, asks, "sensor_id", "measurement_timestamp", "measurement_value", 24)
    found = {(r["sensor_id"], r["measurement_timestamp"]): r["median"] for r in got.collect()}
    want = {(s, t): brute(rows)[i] for i, s, t, v in rows if i in brute(rows)}
    assert found == want


def test_one_hertz_half_empty(spark):
    """Ten hours at one reading a second, every other one null and no short gaps: linear, and no join of readings with the null times."""
    def run(hours):
        n = hours * 3600
        df = spark.range(n).select("id", F.lit("s").alias("sensor_id"), F.timestamp_seconds(F.col("id") + 1_704_067_200).alias("measurement_timestamp"),
                                   F.when(F.col("id") % 2 == 0, (F.col("id") * 7919 % 1000).cast("double")).alias("measurement_value"))
        filled = cleaning.impute_context(df, max_run=0)
        began = time.perf_counter()
        rows = filled.where("imputation_method = 'median'").select("id", "measurement_value").collect()
        return rows, time.perf_counter() - began

    rows, _ = run(1)  # also warms up
    assert len(rows) == 1800
    for r in rows[::97]:
        assert r["measurement_value"] == statistics.median(i * 7919 % 1000 for i in range(0, r["id"], 2))
    rows, first = run(5)
    assert len(rows) == 9000
    rows, second = run(30)
    assert len(rows) == 54_000 and second < 6 * first + 5
    # Readings meet the chunks that someone asks in, once each, never the times that ask.
    plain = spark.createDataFrame([], SCHEMA)
    plan = moving.trailing_median(plain, plain.where("measurement_value IS NULL"), "sensor_id", "measurement_timestamp", "measurement_value", 24)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert len(joins) == 1 and "LeftSemi" in joins[0] and "_chunk" in joins[0] and "measurement_timestamp" not in joins[0]


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert cleaning.impute_context(df).collect() == []
    some = spark.createDataFrame([(1, None, dt.datetime(2024, 1, 1), None), (2, "a", dt.datetime(2024, 1, 1), None), (3, None, dt.datetime(2023, 12, 31), 1.0)], SCHEMA)
    assert {r["id"]: r["measurement_value"] for r in cleaning.impute_context(some).collect()} == {1: None, 2: None, 3: 1.0}


@pytest.mark.parametrize("block", [7, 8192])
def test_many_chunks_are_solved_together(spark, monkeypatch, block):
    """Entities of a few readings share a batch; each still sees only its own, on both sides of midnight and of 1970."""
    from hangarflow.operators import batched

    monkeypatch.setattr(batched, "BLOCK", block)
    rng = random.Random(4)
    rows = [(f"s{i % 60}", dt.datetime(1969, 12, 30) + dt.timedelta(minutes=rng.randrange(6000)), rng.choice([None, 1.0, 2.0, rng.random()])) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    made = moving.trailing_median(df, df.where("v IS NULL"), "k", "t", "v", 24, "m")
    assert "FlatMapGroups" not in made._jdf.queryExecution().executedPlan().toString()  # no call for each chunk
    got = {(r.k, r.t): r.m for r in made.collect()}
    want = {}
    for k, t, v in rows:
        own = [x for a, b, x in rows if a == k and x is not None and t - dt.timedelta(hours=24) <= b < t]
        if v is None and own:
            want[k, t] = statistics.median(own)
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-12 for x in want) and len(want) > 100
