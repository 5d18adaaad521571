"""Feature choice, splits, importance and search against brute force."""

import itertools
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hangarflow.ml import prepare, selection, shap, train

RNG = np.random.default_rng(7)


@pytest.fixture(scope="module")
def frame(spark):
    """500 rows over 60 days: y follows a and b, c is a copy of a with noise, d is noise, e is constant."""
    n = 500
    a, b, d = RNG.normal(1000, 3, n), RNG.normal(size=n), RNG.normal(size=n)
    c = a + RNG.normal(0, 0.5, n)
    y = ((a - 1000) / 3 + b + RNG.normal(0, 0.4, n) > 0.8).astype(int)
    rows = [(f"r{i}", i * 60 // n, *map(float, (a[i], b[i], c[i], d[i], 4.0)), int(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, day int, a double, b double, c double, d double, e double, y int")
    return df.withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("day"))).repartition(5).cache()


COLS = ["a", "b", "c", "d", "e"]


def matrix(df, cols=COLS):
    rows = sorted(df.select("id", *cols, "y").collect())
    return np.array([r[1:-1] for r in rows], float), np.array([r["y"] for r in rows], float)


def test_mutual_information(frame):
    got = {r["column_name"]: r["mutual_information"] for r in selection.mutual_information(frame, COLS, "y", 7).collect()}
    x, y = matrix(frame)
    for j, c in enumerate(COLS):
        v = x[:, j]
        bins = np.minimum(6, np.floor((v - v.min()) * 7 / (v.max() - v.min() or 1))).astype(int)
        want = 0.0
        for i, k in itertools.product(set(bins), (0, 1)):
            p = np.mean((bins == i) & (y == k))
            want += p * math.log(p / (np.mean(bins == i) * np.mean(y == k))) if p else 0
        assert got[c] == pytest.approx(want, abs=1e-12)
    assert got["e"] == 0 and got["d"] < got["a"]
    some = frame.withColumn("a", F.when(F.col("day") > 3, F.col("a"))).withColumn("b", F.when(F.col("day") > 3, F.col("b")).otherwise(F.lit(float("nan"))))
    assert {r["column_name"]: r["records"] for r in selection.mutual_information(some, ["a", "b", "d"], "y").collect()} == {"a": 466, "b": 466, "d": 500}
    assert {r["mutual_information"] for r in selection.mutual_information(frame.limit(0), ["a"], "y").collect()} == {0.0}


def test_lasso_meets_its_conditions(frame):
    x, y = matrix(frame)
    z = (x - x.mean(0)) / np.where(x.std(0) > 1e-9, x.std(0), np.inf)
    for alpha in (0.001, 0.05, 0.2, 5.0):
        got = {r["column_name"]: r["weight"] for r in selection.lasso(frame, COLS, "y", alpha).collect()}
        w = np.array([got[c] for c in COLS])
        pull = z.T @ (y - y.mean() - z @ w) / len(y)
        for j in range(len(COLS)):
            assert pull[j] == pytest.approx(alpha * np.sign(w[j]), abs=1e-8) if w[j] else abs(pull[j]) <= alpha + 1e-8
    assert not np.any(w)
    picked = selection.lasso(frame, COLS, "y", 0.001, top=2).where("selected").count()
    assert picked == 2 and "e" not in selection.select(frame, COLS, "y", "lasso")


def test_recursive_elimination(frame):
    got = sorted(selection.recursive(frame, COLS, "y", folds=3).collect(), key=lambda r: -r["features"])
    days = {r["id"]: r["day"] for r in frame.collect()}
    day = np.array([days[i] for i in sorted(days)])
    x, y = matrix(frame)
    left = list(range(5))
    for r in got:
        errors, weights = [], []
        for i in (1, 2, 3):
            start = 60 - 15 * (4 - i)
            tr, te = day < start, (day >= start) & (day < start + 15)
            std = x[tr][:, left].std(0)
            std = np.where(std > 1e-9, std, np.inf)
            mu = x[tr][:, left].mean(0)
            z, zt = (x[tr][:, left] - mu) / std, (x[te][:, left] - mu) / std
            w = np.linalg.solve(z.T @ z / len(z) + selection.RIDGE * np.eye(len(left)), z.T @ (y[tr] - y[tr].mean()) / len(z))
            errors.append(np.mean((y[te] - y[tr].mean() - zt @ w) ** 2))
            weights.append(np.abs(w))
        assert r["features"] == len(left) and r["error"] == pytest.approx(np.mean(errors), rel=1e-6)
        weakest = min(range(len(left)), key=lambda j: (np.mean([w[j] for w in weights]), -j))
        assert r["dropped"] == COLS[left.pop(weakest)]
    assert [r["best"] for r in got].count(True) == 1 and {"a", "b"} <= set(selection.select(frame, COLS, "y", "recursive"))
    assert selection.recursive(frame.limit(0), COLS, "y").collect() == []
    with pytest.raises(ValueError):
        selection.select(frame, COLS, "y", "guess")


@pytest.mark.parametrize("kind, params", [("decision_tree", {"max_depth": 5}), ("random_forest", {"n_estimators": 7, "max_depth": 6}), ("xgboost", {"n_estimators": 5, "max_depth": 3}), ("logistic_regression", {})])
def test_shap(spark, kind, params):
    """Eight features: values against all subsets of them, and their sum against the model's own score."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8))
    y = (x[:, 0] * x[:, 1] + x[:, 2] + 0.3 * x[:, 3] > 0).astype(int)
    cols = [f"f{i}" for i in range(8)]
    df = spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))], "id int, " + ", ".join(f"{c} double" for c in cols) + ", y int")
    model = train.fit(df, cols, "y", kind, params)
    got = shap.shap_values(model, df, cols, ["id"]).orderBy("id").collect()
    whole = model.transform(df).orderBy("id").collect()
    for r, w in zip(got, whole):
        score = w["rawPrediction"][1] if kind in ("xgboost", "logistic_regression") else w["probability"][1]
        assert r["score"] == pytest.approx(score, abs=1e-9) and r["base"] + sum(r["shap"]) == pytest.approx(score, abs=1e-9)
    top = shap.shap_importance(model, df, cols, ["id"], top=3).collect()
    assert len(top) == 3 and top[0]["mean_abs_shap"] == pytest.approx(max(np.mean(np.abs([r["shap"] for r in got]), axis=0)))
    assert sum(r["importance"] for r in shap.built_in_importance(model, cols, spark).collect()) == pytest.approx(1.0)
    if kind == "logistic_regression":
        return
    trees, base = shap.stored_trees(model.stages[-1], spark)

    def expected(row, known):
        """The trees' value when only some features are known: a leaf's path asks for the others by their share of rows."""
        total = 0.0
        for leaf in trees:
            part = leaf.value
            for f, z, lo, hi in zip(leaf.features, leaf.share, leaf.low, leaf.high):
                part *= float(lo < row[f] <= hi) if f in known else z
            total += part
        return total

    for i in (0, 17, 101):
        row = np.array(whole[i]["features"])
        assert expected(row, ()) == pytest.approx(base)
        values = {s: expected(row, s) for n in range(9) for s in itertools.combinations(range(8), n)}
        for f in range(8):
            phi = sum(math.factorial(len(s)) * math.factorial(7 - len(s)) / math.factorial(8) * (values[tuple(sorted((*s, f)))] - v)
                      for s, v in values.items() if f not in s)
            assert got[i]["shap"][f] == pytest.approx(phi, abs=1e-9)


def test_hash_parts_are_exact(spark):
    rows = [(i, ["x", "y", None][0 if i % 10 < 7 else 1 if i % 10 < 9 else 2]) for i in range(3001)] + [(5000, "once")]
    df = spark.createDataFrame(rows, "id int, label string").repartition(7)
    n = {"x": 2101, "y": 600, None: 300, "once": 1}
    got = prepare.split(df, "stratified", ["id"], "label", ratios=[0.7, 0.15, 0.15])
    counts = {(r["label"], r["split"]): r["count"] for r in got.groupBy("label", "split").count().collect()}
    for label, size in n.items():
        a, b = math.floor(size * 0.7 + 1e-9), math.floor(size * 0.85 + 1e-9)
        assert [counts.get((label, s), 0) for s in ("train", "validation", "test")] == [a, b - a, size - b]
    again = prepare.split(df.orderBy(F.desc("id")), "stratified", ["id"], "label", ratios=[0.7, 0.15, 0.15])
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))
    plain = prepare.split(df, "random", ["id"], ratios=[0.5, 0.25, 0.25])
    assert {r["split"]: r["count"] for r in plain.groupBy("split").count().collect()} == {"train": 1501, "validation": 750, "test": 751}
    folds = prepare.cross_validation(df, "stratified_k_fold", ["id"], "label", folds=4)
    tests = folds.where("role = 'test'")
    assert tests.count() == 3002 and tests.select("id").distinct().count() == 3002 and folds.count() == 4 * 3002
    per = {(r["label"], r["fold"]): r["count"] for r in tests.groupBy("label", "fold").count().collect()}
    assert {per[("x", f)] for f in (1, 2, 3, 4)} <= {525, 526} and {per[("y", f)] for f in (1, 2, 3, 4)} == {150}
    assert prepare.cross_validation(df, "k_fold", ["id"], folds=3).where("role = 'test'").groupBy("fold").count().where("count < 1000").count() == 0
    assert prepare.split(df.limit(0), "stratified", ["id"], "label").collect() == []
    for wrong in (prepare.split, prepare.cross_validation):
        with pytest.raises(ValueError):
            wrong(df, "guess")


def test_folds_leave_a_gap(frame):
    got = prepare.ts_folds(frame, "date", 3, gap=7).groupBy("fold", "role").agg(F.min("day").alias("a"), F.max("day").alias("b")).collect()
    edges = {(r["fold"], r["role"]): (r["a"], r["b"]) for r in got}
    for f in (1, 2, 3):
        assert edges[(f, "test")][0] - edges[(f, "train")][1] == 8


@pytest.mark.parametrize("n", [1, 2, 3, 97, 1000])
def test_every_row_is_numbered_and_moves_once(spark, n):
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    rows = prepare.numbered(df, ["k"], 5, "at").withColumn("to", prepare.permuted(F.col("at"), F.lit(n), 5)).collect()
    assert sorted(r["at"] for r in rows) == sorted(r["to"] for r in rows) == list(range(n))
    if n > 90:
        assert sum(r["at"] == r["to"] for r in rows) < 12 and sum(abs(r["at"] - r["to"]) for r in rows) / n > n / 5


def test_permutation_importance(frame):
    model = train.fit(frame, ["a", "b", "d"], "y", "logistic_regression")
    got = {r["feature"]: r["f1_drop"] for r in train.permutation_importance(model, frame, ["a", "b", "d"], "y", ["id"]).collect()}
    assert got["a"] > 0.1 and got["b"] > 0.1 and abs(got["d"]) < 0.05


def test_expected_improvement():
    seen, open_ = np.array([[0.0], [0.5], [1.0]]), np.array([[0.5], [0.6], [0.25]])
    gain = train.expected_improvement(seen, np.array([0.1, 0.9, 0.2]), open_)
    assert gain[0] < gain[1] and gain[0] == pytest.approx(0, abs=0.02) and (gain >= 0).all()


def test_bayesian_search_goes_on_where_it_stopped(spark, frame):
    from hangarflow.session import work_dir

    space = {"C": [0.001, 0.1, 1.0, 10.0], "max_iter": [5, 50]}
    run = lambda path, n: train.bayesian_search(frame, ["a", "b"], "y", "logistic_regression", path, n, space, folds=2, gap=2, start=2)
    whole, parts = work_dir(spark), work_dir(spark)
    want = sorted(map(tuple, run(whole, 4).collect()))
    run(parts, 1)
    run(parts, 3)
    assert sorted(map(tuple, run(parts, 4).collect())) == want and len(want) == 4
    assert len({w[1] for w in want}) == 4 and all(set(json.loads(w[1])) == set(space) for w in want)
    assert [len(train.grid(s)) for s in train.SPACES.values()] == [288, 324]
    done = {json.dumps(p, sort_keys=True): 0.5 for p in train.grid(space)}
    assert train.next_trial(space, done, 2, 1) is None


def test_experiment_log(spark, frame):
    from hangarflow.session import work_dir

    log = work_dir(spark)
    data = frame.select(F.col("id").alias("aircraft_id"), "date", "a", "b", "d", F.col("y").alias("will_fail_7days"))
    for i, (method, params) in enumerate([("time_based", {}), ("stratified", {"C": 0.5})]):
        train.experiment(data, "logistic_regression", params=params, split={"method": method} | ({"gap": 2} if method == "time_based" else {}), log=log, run_id=f"r{i}")
    rows = train.runs(spark, log).collect()
    assert sorted((r["run_id"], r["dataset"]) for r in rows) == [("r0", "test"), ("r0", "validation"), ("r1", "test"), ("r1", "validation")]
    one = next(r for r in rows if r["run_id"] == "r1")
    assert one["n_features"] == 3 and json.loads(one["parameters"]) == {"C": 0.5} and one["imbalance_method"] == "class_weight"
    assert one["n_train_samples"] + one["n_validation_samples"] + one["n_test_samples"] == 500
    assert 0 < one["metrics"]["f1_score"] <= 1 and one["class_imbalance_ratio"] > 1 and one["dataset_hash"].startswith("500-")
