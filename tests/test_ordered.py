"""Two-level scans must equal plain windows, also with one hot entity and ties."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from hangarflow.operators import joins, ordered


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(1500):
        who = "hot" if i % 3 == 0 else f"e{rng.randrange(8)}"
        t = start + dt.timedelta(minutes=rng.randrange(6000))  # ties happen
        rows.append((i, who, t, rng.random() if rng.random() < 0.5 else None))
    rows.append((5000, "single", start, None))
    return spark.createDataFrame(rows, "id long, who string, t timestamp, x double")


def same(a, b):
    key = lambda r: r.asDict()["id"]
    assert sorted((tuple(sorted(r.asDict().items())) for r in a.collect()), key=repr) == \
        sorted((tuple(sorted(r.asDict().items())) for r in b.collect()), key=repr)


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("width", [600, 3600, 10**9])
def test_nearest_seen(series, forward, inclusive, width):
    spec = {"y": (F.col("x"), F.col("x").isNotNull())}
    kw = dict(order=["id"], forward=forward, inclusive=inclusive)
    same(ordered.nearest_seen(series, "who", "t", spec, width=width, **kw),
         ordered.nearest_seen(series, "who", "t", spec, **kw))


@pytest.mark.parametrize("width", [600, 86400])
def test_running_previous_and_index(series, width):
    for make in (
        lambda w: ordered.previous(series, "who", "t", {"px": "x", "pid": "id"}, ["id"], w),
        lambda w: ordered.running(series, "who", "t", {"s": F.lit(1).cast("long")}, ["id"], w),
        lambda w: ordered.row_index(series, "who", "t", "n", ["id"], w, start=0),
    ):
        same(make(width), make(None))


@pytest.mark.parametrize("parts", [1, 2, 50])
@pytest.mark.parametrize("descending", [False, True])
def test_global_running(spark, parts, descending):
    rng = random.Random(1)
    df = spark.createDataFrame([(float(k), rng.randrange(9)) for k in rng.sample(range(10000), 400)], "k double, n int")
    w = Window.orderBy(F.col("k").desc() if descending else F.col("k")).rowsBetween(Window.unboundedPreceding, 0)
    want = {r.k: r.c for r in df.select("k", F.sum("n").over(w).alias("c")).collect()}
    got = {r.k: r.cum_n for r in ordered.global_running(df, "k", ["n"], parts, descending).collect()}
    assert got == want


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("width", [None, 1800])
def test_asof_brute_force(spark, series, forward, width):
    left = series.select("id", "who", "t")
    right = series.where("x is not null and id % 2 = 0").select("who", F.col("t").alias("rt"), F.col("id").alias("rid"))
    got = {r.id: r.rt for r in joins.asof(left, right, "who", "t", "rt", ["rt", "rid"], forward, width, ["rid"]).collect()}
    lefts, rights = left.collect(), right.collect()
    assert len(got) == len(lefts)
    for r in lefts:
        cand = [q.rt for q in rights if q.who == r.who and (q.rt >= r.t if forward else q.rt <= r.t)]
        assert got[r.id] == ((min if forward else max)(cand) if cand else None)


def test_trailing_counts(spark):
    d = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    snaps = spark.createDataFrame([("a", d(0)), ("a", d(7)), ("a", d(8)), ("b", d(3))], "who string, day date")
    events = spark.createDataFrame([("a", d(0)), ("a", d(0)), ("a", d(5)), ("c", d(1))], "who string, e date")
    got = {(r.who, r.day): r.n for r in joins.trailing_counts(snaps, events, "who", "day", "e", {"n": 7}).collect()}
    assert got == {("a", d(0)): 2, ("a", d(7)): 3, ("a", d(8)): 1, ("b", d(3)): None} or \
        got == {("a", d(0)): 2, ("a", d(7)): 3, ("a", d(8)): 1, ("b", d(3)): 0}


def test_failure_seven_days_inclusive(spark):
    t = dt.datetime(2024, 1, 10)
    left = spark.createDataFrame([(1, "a", t), (2, "a", t - dt.timedelta(days=7)), (3, "a", t - dt.timedelta(days=7, seconds=1)),
                                  (4, "a", t + dt.timedelta(seconds=1)), (5, "b", t)], "id int, who string, t timestamp")
    fails = spark.createDataFrame([("a", t)], "who string, f timestamp")
    got = {r.id: r.label for r in joins.forward_within(left, fails, "who", "t", "f", 7).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0}
