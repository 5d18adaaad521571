"""The daily columns in Arrow batches against the window expressions, and shapes that keep the model rows cheap."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from hangarflow import rules
from hangarflow.ml import prepare
from hangarflow.operators import batched, gold, ordered


def rows(entities, days, holes=0.0, seed=1):
    rng = random.Random(seed)
    cell = lambda: None if rng.random() < holes else float(rng.choice([1.5, 2.25, rng.random() * 100]))
    return [(e, dt.date(2020, 1, 1) + dt.timedelta(days=d), *(cell() for _ in range(4))) for e in entities for d in range(days)]


def same(a, b):
    return a == b or (a is not None and b is not None and (math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)))


@pytest.mark.parametrize("data", [
    rows(["a", "b", "c", None], 45, 0.3) + rows(["d"], 1) + rows(["e"], 60, 1.0) + rows(["f", "g"], 7, 0.8, 2),
    rows([f"x{i}" for i in range(30)], 31) + [("z", dt.date(2020, 1, 1), float("nan"), 1.0, 1.0, 1.0), ("z", dt.date(2020, 1, 2), 2.0, 1.0, 1.0, 1.0)],
    [],
])
@pytest.mark.parametrize("block", [16, 8192])
def test_batches_equal_the_windows(spark, monkeypatch, data, block):
    monkeypatch.setattr(batched, "BLOCK", block)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    df = spark.createDataFrame(data, "aircraft_id string, date date, temperature double, vibration double, pressure double, rpm double").repartition(3)
    try:
        want, got = gold.daily_features(df), gold.daily_features(df, in_batches=True)
        assert got.schema.simpleString() == want.schema.simpleString()
        key = lambda r: (r.aircraft_id or "", r.date)
        want, got = sorted(want.collect(), key=key), sorted(got.collect(), key=key)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(want) == len(data)
    for w, g in zip(want, got):
        for c in w.asDict():
            assert same(w[c], g[c]) if isinstance(w[c], float) or isinstance(g[c], float) else w[c] == g[c], (c, w[c], g[c])


def test_batches_refuse_other_types(spark):
    with pytest.raises(TypeError):
        batched.daily(spark.range(2).withColumn("date", F.lit("2020-01-01").cast("date")), ["id"], [7], "id")


def test_looking_ahead_is_no_shrinking_frame(spark):
    """A frame up to the last row is read anew for each row: work with the square of an entity's days."""
    df = spark.createDataFrame([(1, i, float(i) if i % 3 == 0 else None) for i in range(10)], "k int, t int, v double")
    for width in (None, 4):
        made = ordered.nearest_seen(df, "k", "t", {"n": (F.col("v"), F.col("v").isNotNull())}, width=width, forward=True)
        assert "unboundedfollowing" not in made._jdf.queryExecution().executedPlan().toString()
        assert [r.n for r in made.orderBy("t").collect()] == [0.0, 3.0, 3.0, 3.0, 6.0, 6.0, 6.0, 9.0, 9.0, 9.0]
        past = ordered.nearest_seen(df, "k", "t", {"n": (F.col("v"), F.col("v").isNotNull())}, width=width, forward=True, inclusive=False)
        assert [r.n for r in past.orderBy("t").collect()] == [3.0, 3.0, 3.0, 6.0, 6.0, 6.0, 9.0, 9.0, 9.0, None]


def test_weights_do_not_shuffle_the_rows(spark):
    df = spark.createDataFrame([(i, i % 4 == 0) for i in range(40)], "i int, y boolean")
    made = prepare.weighted(df, "y")
    text = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text
    assert {(r.y, r.weight) for r in made.collect()} == {(True, 2.0), (False, 40 / 60)} and made.columns == ["y", "i", "weight"]


def test_methods_stay_small_enough_to_be_compiled(spark):
    from hangarflow.session import configure

    assert int(configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000 and rules.WINDOWS_DAYS == [7, 14, 30]


def test_a_kept_experiment_writes_its_rows_no_second_time(spark, monkeypatch):
    from hangarflow.ml import train

    seen, real = [], train.staged
    monkeypatch.setattr(train, "staged", lambda df: (seen.append(df.columns), real(df))[1])
    rng = random.Random(3)
    data = [(i % 4, dt.date(2020, 1, 1) + dt.timedelta(days=i // 4), rng.random(), rng.random(), rng.randrange(2)) for i in range(400)]
    df = spark.createDataFrame(data, "aircraft_id int, date date, a double, b double, will_fail_7days int")
    made = [train.experiment(df, "logistic_regression", params={"max_iter": 5}, kept=k)[1].orderBy("dataset").collect() for k in (True, False)]
    assert made[0] == made[1] and sum("a" in c for c in seen) == 1
