"""Edge cases: nulls, single rows, ties, empty tables, values on a threshold."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from hangarflow.functions import scalars
from hangarflow.ml import evaluate, prepare
from hangarflow.operators import cleaning, decisions, labels, monitor, profile, quality, windows
from hangarflow.session import work_dir
from hangarflow.sources import files, tables


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def series(spark, values, who="a"):
    return spark.createDataFrame([(who, day(i), v) for i, v in enumerate(values)], "aircraft_id string, date date, x double")


def column(df, col="x"):
    return [r[col] for r in df.orderBy("aircraft_id", "date").collect()]


def test_ladders_on_thresholds(spark):
    df = spark.createDataFrame([(0.25,), (0.5,), (0.75,), (0.2499,), (None,)], "p double")
    assert [r[0] for r in df.select(scalars.risk_level(F.col("p"))).collect()] == ["medium", "high", "critical", "low", "low"]
    df = spark.createDataFrame([(4.0,), (4.1,), (24.0,), (24.1,), (48.0,), (48.1,), (None,)], "h double")
    assert [r[0] for r in df.select(scalars.severity(F.col("h"))).collect()] == [
        "negligible", "minor", "minor", "major", "major", "critical", "negligible"]
    df = spark.createDataFrame([(0, 10), (10, 10), (11, 10), (30, 10), (31, 10), (5, None), (-1, None)], "a int, r int")
    want = ["out_of_stock", "low_stock", "in_stock", "in_stock", "overstock", "in_stock", "out_of_stock"]
    assert [r[0] for r in df.select(scalars.stock_status(F.col("a"), F.col("r"))).collect()] == want
    scalars.register_sql(spark)
    df.createOrReplaceTempView("stock_levels")
    assert [r[0] for r in spark.sql("SELECT calculate_stock_status(a, r) FROM stock_levels").collect()] == want


def test_units_times_ids(spark):
    df = spark.createDataFrame([
        ("temperature", "fahrenheit", 212.0), ("temperature", "kelvin", 273.15), ("temperature", "celsius", 5.0),
        ("pressure", "psi", 10.0), ("pressure", "pascal", 100000.0), ("pressure", "bar", 2.0), ("rpm", None, 7.0)],
        "t string, u string, v double")
    v, u = scalars.convert_units(F.col("v"), F.col("u"), F.col("t"))
    got = [(round(r[0], 6), r[1]) for r in df.select(v, u).collect()]
    assert got == [(100.0, "celsius"), (0.0, "celsius"), (5.0, "celsius"), (0.689476, "bar"), (1.0, "bar"), (2.0, "bar"), (7.0, None)]
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02T03:04:05",), ("2024-01-02 03:04:05.250000",), ("soon",), (None,)], "s string")
    base = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert [r[0] for r in df.select(scalars.parse_time(F.col("s"))).collect()] == [base, base, base.replace(microsecond=250000), None, None]
    df = spark.createDataFrame([("  ac_1. temp/x ",)], "s string")
    assert df.select(scalars.normalise_id(F.col("s"))).first()[0] == "AC-1-TEMP-X"


def test_fill_and_interpolate(spark):
    s = series(spark, [None, None, 1.0, None, None, 4.0, None])
    for width in (None, 2):
        assert column(cleaning.impute(s, ["x"], "forward_fill", width=width)) == [1.0, 1.0, 1.0, 1.0, 1.0, 4.0, 4.0]
        assert column(cleaning.impute(s, ["x"], "interpolate", width=width)) == [None, None, 1.0, 2.0, 3.0, 4.0, 4.0]
    two = s.unionByName(series(spark, [None, 9.0], "b"))
    assert column(cleaning.impute(two, ["x"], "forward_fill"))[-2:] == [9.0, 9.0]  # never across entities
    assert column(cleaning.impute(s, ["x"], "mean")) == [2.5, 2.5, 1.0, 2.5, 2.5, 4.0, 2.5]
    assert column(cleaning.impute(s, ["x"], "drop")) == [1.0, 4.0]
    assert column(cleaning.impute(series(spark, [None, None]), ["x"], "forward_fill")) == [None, None]
    with pytest.raises(ValueError):
        cleaning.impute(s, ["x"], "guess")


def test_context_fill(spark):
    t0 = dt.datetime(2024, 1, 2)
    m = lambda n: t0 + dt.timedelta(minutes=n)
    rows = [(0, m(-120), 3.0), (1, m(-90), 5.0), (2, m(0), 10.0)] + [(2 + i, m(i * 8), None) for i in range(1, 8)] + [(20, m(1500 * 2), None)]
    df = spark.createDataFrame([(i, "s", t, v) for i, t, v in rows],
                               "id int, sensor_id string, measurement_timestamp timestamp, measurement_value double")
    for width in (600, 3600, 10**8):
        got = {r.id: (r.measurement_value, r.imputation_method) for r in cleaning.impute_context(df, width=width).collect()}
        assert got[3] == (10.0, "forward_fill") and got[7] == (10.0, "forward_fill")  # fifth fill
        assert got[8] == (5.0, "median") and got[9] == (5.0, "median")  # sixth and later: median of 3, 5 and 10, all in the day before
        assert got[20] == (None, None)  # nothing within 24 hours
        assert got[2] == (10.0, None)


def test_outliers(spark):
    s = series(spark, [1.0, 2.0, 3.0, 4.0, 100.0, None])
    capped = column(cleaning.outliers(s, ["x"], "iqr", 3.0))
    assert capped == [1.0, 2.0, 3.0, 4.0, 10.0, None]
    assert column(cleaning.outliers(s, ["x"], "iqr", 3.0, "flag"), "x_is_outlier") == [False] * 4 + [True, False]
    assert column(cleaning.outliers(s, ["x"], "iqr", 3.0, "remove")) == [1.0, 2.0, 3.0, 4.0, None]
    again = cleaning.outliers(cleaning.outliers(s, ["x"], "iqr", 3.0), ["x"], "iqr", 3.0)
    assert column(again) == capped
    with pytest.raises(ValueError):
        cleaning.outliers(s, ["x"], "magic")


def test_keep_first_and_copies(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (2, None, "z"), (1, 5, "a"), (1, 5, "a")], "k int, v int, s string")
    got = {r.k: (r.v, r.s) for r in cleaning.keep_first(df, "k", ["s", "v"]).collect()}
    assert got == {1: (5, "a"), 2: (None, "z")}
    few = cleaning.collapse_copies(df)
    assert few.count() == 3
    for pieces in (1, 2, 1024):
        back = cleaning.expand_copies(few, pieces=pieces)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_window_features_with_nulls_and_single_rows(spark):
    s = series(spark, [1.0, None, 4.0]).unionByName(series(spark, [7.0], "b"))
    got = windows.trend(windows.rolling(s, ["x"], [2]), ["x"], [2]).orderBy("aircraft_id", "date").collect()
    assert [r.x_rolling_mean_2d for r in got] == [1.0, 1.0, 4.0, 7.0]
    assert [r.x_rolling_std_2d for r in got] == [None] * 4
    assert [r.x_slope_2d for r in got] == [None] * 4
    flat = windows.anomaly(series(spark, [2.0, 2.0]), ["x"]).collect()
    assert [r.x_zscore for r in flat] == [0.0, 0.0]
    norm = windows.minmax(series(spark, [2.0, 2.0]).withColumnRenamed("aircraft_id", "engine_id"), ["x"])
    assert [r.x_norm for r in norm.collect()] == [None, None]


def test_quality_on_empty_and_full(spark):
    empty = series(spark, [])
    assert quality.validity(empty, {"x": (0, 1)}).first()[0] == 1.0
    assert quality.completeness(empty).first()[0] is None
    assert quality.consistency(empty, "aircraft_id", "date", "x").first()[0] == 1.0
    assert profile.value_distribution(empty, "aircraft_id").count() == 0
    s = series(spark, [0.0, 1.0, 2.0, None])
    assert quality.validity(s, {"x": (0, 1)}).first()[0] == pytest.approx(2 / 3)
    assert quality.completeness(s).first()[0] == pytest.approx(11 / 12)
    up_and_down = s.unionByName(series(spark, [3.0, 1.0], "b")).unionByName(series(spark, [3.0], "c"))
    row = quality.consistency(up_and_down, "aircraft_id", "date", "x").first()
    assert (row.consistency, row.entities_checked) == (0.5, 2)
    assert quality.timeliness(s, "date", "2024-01-04").first()[0] == 1.0
    assert quality.timeliness(s, "date", "2030-01-04").first()[0] == 0.0
    with pytest.raises(ValueError):
        quality.require_columns(s, ["y"], strict=True)


def test_error_policies(spark):
    raw = spark.createDataFrame([("1", "ok"), ("x", "bad"), (None, "empty")], "v string, n string")
    c = quality.conform(raw, {"v": "int"})
    good, bad, rate = quality.apply_policy(c, "quarantine")
    assert {r.n for r in good.collect()} == {"ok", "empty"} and [r.n for r in bad.collect()] == ["bad"]
    assert rate.first().within_limit is False
    assert quality.apply_policy(c, "log_and_continue")[0].count() == 3
    with pytest.raises(Exception, match="bad cells"):
        quality.apply_policy(c, "fail_fast")[0].collect()


def test_rul_invariants(spark):
    df = spark.createDataFrame([(e, c) for e in (1, 2) for c in range(1, 41)], "engine_id int, cycle int")
    got = labels.within(labels.rul(df)).collect()
    assert all(r.RUL == 40 - r.cycle for r in got)
    assert sum(r.failed for r in got) == 2
    assert {r.will_fail_30_cycles for r in got if r.RUL == 30} == {1} and {r.will_fail_30_cycles for r in got if r.RUL == 31} == {0}


def test_golden_split(spark):
    df = spark.createDataFrame([(i, dt.date(2023, 1, 1) + dt.timedelta(days=i)) for i in range(100)], "aircraft_id int, date date")
    parts = {}
    for r in prepare.time_split(df, mode="rows").collect():
        parts.setdefault(r.split, []).append(r.aircraft_id)
    assert sorted(parts["train"]) == list(range(70))
    assert sorted(parts["validation"]) == list(range(77, 85))
    assert sorted(parts["test"]) == list(range(92, 100))
    with pytest.raises(ValueError):
        prepare.time_split(df, ratios=(0.5, 0.1, 0.1))


def test_split_of_ties(spark):
    df = spark.createDataFrame([(i, day(i % 3)) for i in range(60)], "aircraft_id int, date date")
    want = sorted(range(60), key=lambda i: (i % 3, i))
    label = lambda p: "train" if p < 42 else "gap" if p < 49 else "validation" if p < 51 else "gap" if p < 58 else "test"
    for width in (None, 10):
        got = {r.aircraft_id: r.split for r in prepare.time_split(df, mode="rows", width=width).collect()}
        assert got == {i: label(p) for p, i in enumerate(want)}


def test_metrics_match_definitions(spark):
    rows = [(1, 0.9), (1, 0.8), (0, 0.8), (0, 0.3), (1, 0.3), (0, 0.1)]
    df = spark.createDataFrame([(y, p, int(p >= 0.5)) for y, p in rows], "label int, failure_probability double, prediction int")
    m = evaluate.metrics(df).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (2, 1, 1, 2)
    pairs = [(a, b) for y, a in rows if y for z, b in rows if not z]
    assert m.roc_auc == pytest.approx(sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs))
    none = evaluate.metrics(df.where("label = 0 and prediction = 0")).first()
    assert (none.precision, none.recall, none.f1_score) == (0.0, 0.0, 0.0)
    assert evaluate.confusion(df.where("label = 1")).count() == 4
    points = evaluate.roc(df).orderBy(F.desc("threshold")).collect()
    assert all(a.tpr <= b.tpr and a.fpr <= b.fpr for a, b in zip(points, points[1:]))
    assert (points[-1].tpr, points[-1].fpr) == (1.0, 1.0)


def test_drift_of_itself_is_zero(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(100)], "k string, v double")
    assert monitor.psi(df, df, "v", "k").first().psi == pytest.approx(0.0)
    assert monitor.ks(df, df, "v").first().ks_statistic == 0.0
    moved = df.withColumn("v", F.col("v") + 1000)
    assert monitor.psi(df, moved, "v", "k").first().drifted is True
    assert monitor.ks(df, moved, "v").first().ks_statistic == 1.0


def test_upsert_semantics(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, name string, v double")
    batch = spark.createDataFrame([(2, "x", 9.0, 1), (2, "y", 8.0, 2), (3, "z", None, 1)], "k int, name string, v double, n int")
    once = tables.upsert(target, batch, "k", ["n"], ["v"])
    assert {tuple(r) for r in once.collect()} == {(1, "a", 1.0), (2, "b", 8.0), (3, "z", None)}
    twice = tables.upsert(once, batch, "k", ["n"], ["v"])
    assert {tuple(r) for r in twice.collect()} == {tuple(r) for r in once.collect()}
    path = work_dir(spark)
    target.write.partitionBy("k").parquet(path)
    assert tables.upsert_path(batch, path, ["k", "name"], ["n"], by=["k"], schema=target.schema) == 4
    with pytest.raises(ValueError):
        tables.upsert_path(batch, path, ["name"], ["n"], by=["k"], schema=target.schema)


def test_append_modes(spark):
    path = work_dir(spark)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert tables.append(df, path) == 2
    more = spark.createDataFrame([(2, "x"), (3, "y"), (3, "c")], "k int, v string")
    with pytest.raises(ValueError):
        tables.append(more, path, "k", "error")
    assert tables.append(more, path, "k", "ignore", ["v"]) == 1
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "b"), (3, "c")}
    with pytest.raises(ValueError):
        tables.append(more, path, "k", "update")


def test_scd2_versions(spark):
    t = lambda n: dt.datetime(2024, 1, n)
    rows = [("a", "O", t(1), 1), ("a", "O", t(2), 2), ("a", "P", t(3), 3), ("a", "O", t(3), 4), ("a", "P", t(20), 5), ("a", "O", t(25), 6), ("b", "F", t(1), 7)]
    df = spark.createDataFrame(rows, "who string, s string, at timestamp, id int")
    for width in (None, 86400, 30 * 86400):
        got = tables.scd2(df, "who", "at", "s", "id", width).orderBy("who", "version_number").collect()
        a = [r for r in got if r.who == "a"]
        assert [(r.s, r.effective_start_date.day, r.version_number, r.is_current) for r in a] == [
            ("O", 1, 1, False), ("P", 20, 2, False), ("O", 25, 3, True)]
        assert all(x.effective_end_date == y.effective_start_date for x, y in zip(a, a[1:]))
        assert a[-1].effective_end_date.year == 9999


def test_kpi_on_empty_dimension(spark):
    dim = spark.createDataFrame([], "aircraft_id int, operational_status string, is_current boolean")
    alerts = spark.createDataFrame([], "alert_id string, aircraft_id int, alert_timestamp timestamp, severity string, status string")
    preds = spark.createDataFrame([], "aircraft_id int, prediction_date date, failure_probability double, risk_level string")
    recs = spark.createDataFrame([(day(0), "p", "order", "urgent")],
                                 "recommendation_date date, part_number string, recommendation_type string, recommended_priority string")
    row = decisions.kpi(dim, alerts, preds, recs, "2024-01-01").first()
    assert row.total_aircraft == 0 and row.avg_failure_probability is None and row.urgent_part_orders == 0


def test_neighbours_are_exact(spark):
    """More points than a fixed number of candidates reaches; whole and part leaves, ties, missing coordinates, few points."""
    rng = random.Random(8)
    centres = [[rng.gauss(0, 3) for _ in range(10)] for _ in range(20)]
    far = [(i, [c + rng.gauss(0, 1) for c in centres[i % 20]]) for i in range(1500)]
    grid = [(i, [float(i % 12), float(i // 12), None if i == 77 else 1.0]) for i in range(144)]
    for pts, limits in ((far, {}), (far, {"leaf": 50, "levels": 2}), (grid, {"leaf": 10}), (far[:4], {})):
        df = spark.createDataFrame(pts, "id long, x array<double>")
        got = {}
        for r in prepare.neighbours(df, 5, **limits).orderBy("id", "rank").collect():
            got.setdefault(r.id, []).append((r.n_id, r.d))
        plain = [(i, [v or 0.0 for v in x]) for i, x in pts]
        for i, x in plain:
            want = sorted((math.dist(x, y), j) for j, y in plain if j != i)[:5]
            assert [d for _, d in got[i]] == pytest.approx([d for d, _ in want]), (i, limits)
            assert pts is grid or [j for j, _ in got[i]] == [j for _, j in want]


def test_smote_counts_and_range(spark):
    rows = [(i, float(i), 1.0, int(i < 20)) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y int")
    for ratio, n in ((1.0, 60), (0.5, 20), (0.9, 52), (0.2, 0)):
        made = prepare.smote(df, ["a", "b"], "y", ["id"], ratio).collect()
        new = [r for r in made if r.is_synthetic]
        assert all(r.y == 1 and 0.0 <= r.a <= 19.0 and r.b == 1.0 for r in new)
        assert len(new) == n and len(made) - len(new) == 100


def test_resampling_is_exact(spark):
    df = spark.createDataFrame([(i, int(i % 10 < 3), "x") for i in range(1000)], "id int, y int, copy string")
    for ratio in (0.5, 0.75, 1.0):
        under = prepare.resample(df, "y", ["id"], "under", ratio).groupBy("y").count().collect()
        assert {r.y: r["count"] for r in under} == {1: 300, 0: round(300 / ratio)}
        over = prepare.resample(df, "y", ["id"], "over", ratio)
        assert {r.y: r["count"] for r in over.groupBy("y").count().collect()} == {1: max(300, round(700 * ratio)), 0: 700}
        assert over.where("y = 1").groupBy("id").count().agg({"count": "max"}).first()[0] <= 1 + 700 * ratio // 300
    assert prepare.smallest_hash(df, 5000, ["id"], 1).count() == 1000 and prepare.smallest_hash(df, 0, ["id"], 1).count() == 0


def test_median_reaches_back_24_hours_from_the_reading(spark):
    base = dt.datetime(2024, 1, 2, 10, 0)
    rows = [(i, "s", base + dt.timedelta(minutes=m), v) for i, (m, v) in enumerate([(0, 0.0), (5, 1.0), (10, 2.0), (11, None), (100, None), (24 * 60 + 6, None), (24 * 60 + 10, None)])]
    # The short gap is switched off, so every null takes the median of [t - 24 h, t).
    df = spark.createDataFrame(rows, "id int, sensor_id string, measurement_timestamp timestamp, measurement_value double")
    got = {r.id: r.measurement_value for r in cleaning.impute_context(df, gap_minutes=-1).collect()}
    assert [got[i] for i in range(3, 7)] == [1.0, 1.0, 2.0, 2.0]
    got = {r.id: (r.measurement_value, r.imputation_method) for r in cleaning.impute_context(df).collect()}
    assert got[3] == (2.0, "forward_fill") and got[4] == (1.0, "median")


def test_entropy_follows_the_range_of_the_kind(spark):
    base = dt.datetime(2024, 1, 2, 10, 0)
    rows = [(1, "rpm", base + dt.timedelta(minutes=i), 2000.0 + 200 * (i % 10)) for i in range(50)] + [(1, "flat", base, 7.0)]
    df = spark.createDataFrame(rows, "aircraft_id int, sensor_type string, measurement_timestamp timestamp, measurement_value double")
    got = {r.sensor_type: r.entropy for r in windows.stat_features(df, keys=("sensor_type",)).collect()}
    assert abs(got["rpm"] - math.log(10)) < 1e-9 and got["flat"] == 0.0


def test_dataset_compare_with_missing_cycles(spark):
    df = spark.createDataFrame([("a", 1, c) for c in (1, 2, 3, 100, 101)], "dataset string, engine_id int, cycle int")
    assert profile.dataset_compare(df).first().failure_rate == 40.0


def test_kpi_counts_an_alert_once(spark):
    day = dt.date(2024, 1, 2)
    dim = spark.createDataFrame([(1, "active", True), (2, "active", True)], "aircraft_id int, operational_status string, is_current boolean")
    at = dt.datetime(2024, 1, 2, 3)
    alerts = spark.createDataFrame([("a", 1, at, "critical", "open")] * 2 + [("b", 2, at, "high", "closed"), ("c", 3, at, "high", "open")],
                                   "alert_id string, aircraft_id int, alert_timestamp timestamp, severity string, status string")
    preds = spark.createDataFrame([(1, day, 0.9, "critical"), (2, day, 0.3, "low")], "aircraft_id int, prediction_date date, failure_probability double, risk_level string")
    recs = spark.createDataFrame([(day, "order", "urgent", 5)], "recommendation_date date, recommendation_type string, recommended_priority string, part_number int")
    row = decisions.kpi(dim, alerts, preds, recs, "2024-01-02").first()
    assert (row.total_alerts_today, row.critical_alerts_open, row.high_alerts_open) == (2, 1, 0)
    assert abs(row.avg_failure_probability - (2 * 0.9 + 0.3) / 3) < 1e-12


def test_whitespace_scan_and_run(spark):
    path = work_dir(spark)
    lines = spark.createDataFrame([("  1   1 0.5 0 0 " + " ".join(["2"] * 21) + "  ", "FD001"), ("2 3 1 1", "FD002"), ("", "FD002")], "value string, source string")
    lines.write.partitionBy("source").text(path)
    got = {r.engine_id: r for r in files.run_to_failure(spark, path).collect()}
    assert got[1].dataset == "FD001" and got[1].sensor_21 == 2.0
    assert got[2].dataset == "FD002" and got[2].cycle == 3 and got[2].sensor_1 is None


def test_full_run_from_files(spark):
    from hangarflow.operators import gold

    bronze, silver, gold_path = (work_dir(spark) for _ in range(3))
    rows = [(f"AC{a}", day(i), i, 400.0 + i if i % 3 else None, 1.0, 90.0, 3000.0 + i, 1.0, 2.0, 3.0, 0, None, 0)
            for a in range(2) for i in range(40)]
    rows += [rows[5]] * 50  # copies
    from hangarflow import schemas

    df = spark.createDataFrame(rows, schemas.struct(schemas.DAILY))
    df.write.option("header", True).csv(bronze)
    row = gold.run(spark, bronze, silver, gold_path).first()
    assert (row.bronze_records, row.silver_records, row.gold_records) == (130, 80, 80)
    assert (row.bronze_features, row.gold_features) == (13, 87)
    assert row.quality_passed is True
    plain = gold.silver_daily(spark.read.schema(df.schema).option("header", True).csv(bronze))
    both = spark.read.parquet(silver)
    assert sorted(map(str, both.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_contributions_of_a_day_that_sums_to_zero(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [(1, t, "error", 0.0), (1, t, "rpm", 0.0), (2, t, "error", -2.0), (2, t, "rpm", 2.0), (3, t, "error", 1.0), (3, t, "rpm", 3.0), (4, t, "rpm", None)]
    df = spark.createDataFrame(rows, "aircraft_id int, measurement_timestamp timestamp, sensor_type string, measurement_value double")
    got = {r.aircraft_id: (r.most_likely_component, r.contributing_sensors_json) for r in decisions.contributions(df).collect()}
    assert got[1] == ("error", '[{"sensor":"error","contribution":NaN},{"sensor":"rpm","contribution":NaN}]')
    assert got[2] == ("rpm", '[{"sensor":"rpm","contribution":Infinity},{"sensor":"error","contribution":-Infinity}]')
    assert got[3] == ("rpm", '[{"sensor":"rpm","contribution":75.0},{"sensor":"error","contribution":25.0}]')
    assert got[4] == ("rpm", '[{"sensor":"rpm"}]')
