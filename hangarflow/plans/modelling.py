"""Splits, weights, scaling, metrics, curves and model queries."""

from pyspark.sql import functions as F

from hangarflow import bindings as B, rules
from hangarflow.ml import evaluate, forest, prepare, selection, shap, train
from hangarflow.operators import gold
from hangarflow.plans.registry import out, query
from hangarflow.plans.sql_views import S4, VIEWS
from hangarflow.session import scratch, staged, work_dir

LABEL = "will_fail_7days"
KEY = ["aircraft_id", "date"]

VIEWS["split_rows"] = ("labeled", """SELECT *, CASE WHEN pos < a THEN 'train' WHEN pos < a + 7 THEN 'gap' WHEN pos < b THEN 'validation' WHEN pos < b + 7 THEN 'gap' ELSE 'test' END AS split
    FROM (SELECT *, row_number() OVER (ORDER BY date, aircraft_id) - 1 AS pos, floor(count(*) OVER () * 0.7::DOUBLE) AS a, floor(count(*) OVER () * (0.7::DOUBLE + 0.15::DOUBLE)) AS b FROM labeled)""")
VIEWS["cuts"] = ("labeled", """SELECT max(CASE WHEN before <= floor(total * 0.7::DOUBLE) THEN date END) AS a, max(CASE WHEN before <= floor(total * (0.7::DOUBLE + 0.15::DOUBLE)) THEN date END) AS b
    FROM (SELECT date, sum(n) OVER (ORDER BY date) - n AS before, sum(n) OVER () AS total FROM (SELECT date, count(*) AS n FROM labeled GROUP BY 1))""")


@query("time_split", out("""
    SELECT 'rows' AS mode, split, count(*) AS records, min(date) AS first_date, max(date) AS last_date, sum(will_fail_7days)::BIGINT AS failures FROM split_rows GROUP BY 2
    UNION ALL SELECT 'days', CASE WHEN date < a THEN 'train' WHEN date >= a + 7 AND date < b THEN 'validation' WHEN date >= b + 7 THEN 'test' ELSE 'gap' END,
        count(*), min(date), max(date), sum(will_fail_7days)::BIGINT FROM labeled, cuts GROUP BY 2""", date="first_date last_date", views="split_rows cuts"))
def time_split(spark, sf):
    """Both gap modes; every row is placed, and the result is summed per part."""
    d = B.daily_labeled(spark, sf).select("aircraft_id", "date", LABEL)
    made = None
    for mode in ("rows", "days"):
        parts = prepare.time_split(d, mode=mode, width=1_000_000)
        one = parts.groupBy(F.lit(mode).alias("mode"), "split").agg(
            F.count(F.lit(1)).alias("records"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.sum(LABEL).alias("failures"))
        made = one if made is None else made.unionByName(one)
    return made


@query("time_split_rows", out("SELECT aircraft_id, date, split FROM split_rows", date="date", views="split_rows"))
def time_split_rows(spark, sf):
    d = B.daily_labeled(spark, sf).select("aircraft_id", "date")
    return prepare.time_split(d, mode="rows", width=1_000_000)


@query("ts_cv", out("""
    SELECT fold::INTEGER AS fold, CASE WHEN idx < d - size * (6 - fold) THEN 'train' ELSE 'test' END AS role, count(*) AS records, min(date) AS first_date, max(date) AS last_date
    FROM (SELECT *, d // 6 AS size FROM (SELECT date, dense_rank() OVER (ORDER BY date) - 1 AS idx FROM labeled), (SELECT count(DISTINCT date) AS d FROM labeled)), range(1, 6) f(fold)
    WHERE idx < d - size * (6 - fold) + size GROUP BY 1, 2""", date="first_date last_date", views="labeled"))
def ts_cv(spark, sf):
    d = B.daily_labeled(spark, sf).select("aircraft_id", "date")
    return prepare.ts_folds(d).groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("records"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query("class_weights", out("""
    SELECT label, count(*) AS records, (SELECT count(*) FROM scored)::DOUBLE / (2 * count(*)) AS weight,
        ((SELECT count(*) FROM scored) - count(*))::DOUBLE / count(*) AS imbalance_ratio FROM scored GROUP BY 1""",
    dbl="weight imbalance_ratio", views="scored"))
def class_weights(spark, sf):
    return prepare.class_weights(B.scored(spark, sf))


_C3 = ["ambient_temp", "flight_hours"]


def _scaled_sql(method):
    a, b = {"standard": ("avg({c})", "stddev_pop({c})"), "minmax": ("min({c})", "max({c}) - min({c})"),
            "robust": ("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)")}[method]
    fit = ", ".join(f"{a.format(c=c)} AS a_{c}, {b.format(c=c)} AS b_{c}" for c in _C3)
    cols = ", ".join(f"({c} - a_{c}) / b_{c} AS {c}" for c in _C3)
    return f"SELECT '{method}' AS method, aircraft_id, date, {cols} FROM labeled, (SELECT {fit} FROM split_rows WHERE split = 'train')"


@query("scale", out(" UNION ALL ".join(map(_scaled_sql, ["standard", "minmax", "robust"])), dbl=" ".join(_C3), date="date", views="labeled split_rows"))
def scale(spark, sf):
    """All rows scaled with the statistics of the training part only."""
    d = B.daily_labeled(spark, sf).select("aircraft_id", "date", *_C3)
    split = staged(prepare.time_split(d, mode="rows", width=1_000_000))  # each method reads it
    fit_on, d = split.where("split = 'train'"), split.drop("split")
    made = None
    for m in ("standard", "minmax", "robust"):
        one = prepare.scale(fit_on, d, _C3, m).select(F.lit(m).alias("method"), "*")
        made = one if made is None else made.unionByName(one)
    return made


VIEWS["sel_src"] = ("labeled", """SELECT ambient_temp, flight_hours, ambient_temp * 2 + 1 AS ambient_double, 1.0::DOUBLE AS always_one, failed::DOUBLE AS failed_today,
    cycle::DOUBLE AS cycle_no, will_fail_7days FROM labeled""")
_SEL = ["ambient_temp", "flight_hours", "ambient_double", "always_one", "failed_today", "cycle_no"]


VIEWS["strengths"] = ("sel_src", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, var_samp({c}) AS variance, CASE WHEN var_samp({c}) > 0.01 THEN abs(corr({c}, will_fail_7days)) END AS strength FROM sel_src" for c in _SEL))

@query("feature_select", out("""
    SELECT column_name, variance, reason = 'kept' AS selected, reason FROM (SELECT column_name, variance, CASE WHEN variance <= 0.01 THEN 'low_variance'
        WHEN column_name = 'ambient_double' AND (SELECT abs(corr(ambient_temp, ambient_double)) > 0.95 FROM sel_src) THEN 'correlated'
        WHEN 4 <= (SELECT count(*) FROM strengths o WHERE o.strength > s.strength AND column_name <> 'ambient_double') THEN 'not_in_top' ELSE 'kept' END AS reason
        FROM strengths s)""", dbl="variance", views="strengths"))
def feature_select(spark, sf):
    d = B.daily_labeled(spark, sf)
    src = d.select("ambient_temp", "flight_hours", (F.col("ambient_temp") * 2 + 1).alias("ambient_double"), F.lit(1.0).alias("always_one"),
                   F.col("failed").cast("double").alias("failed_today"), F.col("cycle").cast("double").alias("cycle_no"), LABEL)
    return prepare.feature_report(src, _SEL, LABEL)


_CNT = """count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn"""
VIEWS["curve"] = ("scored", """SELECT threshold, pos, neg, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER () AS p, sum(neg) OVER () AS n
    FROM (SELECT failure_probability AS threshold, count(*) FILTER (WHERE label = 1)::DOUBLE AS pos, count(*) FILTER (WHERE label = 0)::DOUBLE AS neg FROM scored GROUP BY 1)
    WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")


@query("metrics", out(f"""
    SELECT *, tp / (tp + fp)::DOUBLE AS "precision", tp / (tp + fn)::DOUBLE AS recall, 2 * tp / (2 * tp + fp + fn)::DOUBLE AS f1_score, (tp + tn) / (tp + fp + fn + tn)::DOUBLE AS accuracy,
        fp / (fp + tn)::DOUBLE AS false_positive_rate, (SELECT sum(neg * (cp - pos / 2)) / max(p * n) FROM curve) AS roc_auc, (SELECT sum(pos / p * cp / (cp + cn)) FROM curve) AS average_precision
    FROM (SELECT {_CNT} FROM scored)""", dbl='"precision" recall f1_score accuracy false_positive_rate roc_auc average_precision', views="scored curve"))
def metrics(spark, sf):
    return evaluate.metrics(B.scored(spark, sf))


@query("confusion", out("""SELECT a::INTEGER AS actual, p::INTEGER AS predicted, (SELECT count(*) FROM scored WHERE label = a AND prediction = p) AS records
    FROM range(2) x(a), range(2) y(p)""", views="scored"))
def confusion(spark, sf):
    return evaluate.confusion(B.scored(spark, sf))


@query("class_report", out(f"""
    SELECT 'No Failure' AS "class", tn / (tn + fn)::DOUBLE AS "precision", tn / (tn + fp)::DOUBLE AS recall, 2 * tn / (2 * tn + fn + fp)::DOUBLE AS f1_score, tn + fp AS support FROM (SELECT {_CNT} FROM scored)
    UNION ALL SELECT 'Failure', tp / (tp + fp)::DOUBLE, tp / (tp + fn)::DOUBLE, 2 * tp / (2 * tp + fp + fn)::DOUBLE, tp + fn FROM (SELECT {_CNT} FROM scored)""",
    dbl='"precision" recall f1_score', views="scored"))
def class_report(spark, sf):
    return evaluate.class_report(B.scored(spark, sf))


@query("roc_curve", out("SELECT threshold, cn / n AS fpr, cp / p AS tpr FROM curve", dbl="threshold fpr tpr", views="curve"))
def roc_curve(spark, sf):
    return evaluate.roc(B.scored(spark, sf))


@query("pr_curve", out('SELECT threshold, cp / (cp + cn) AS "precision", cp / p AS recall FROM curve', dbl='threshold "precision" recall', views="curve"))
def pr_curve(spark, sf):
    return evaluate.pr(B.scored(spark, sf))


# ----------------------------------------------------- feature choice and splits

_SEL8 = ["temperature", "vibration", "pressure", "rpm", "altitude", "ambient_temp", "flight_hours", "cycle"]
_bins = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, will_fail_7days AS y, least(9, coalesce(floor(({c} - min({c}) OVER ()) * 10 / nullif(max({c}) OVER () - min({c}) OVER (), 0)), 0)) AS x FROM history WHERE {c} IS NOT NULL"
    for c in _SEL8)
VIEWS["mi_cells"] = ("history", f"SELECT column_name, x, y, count(*)::DOUBLE AS n FROM ({_bins}) GROUP BY ALL")


@query("mutual_info", out("""
    SELECT column_name, greatest(0, sum(n / t * ln(n * t / (nx * ny)))) AS mutual_information, sum(n)::BIGINT AS records FROM (
        SELECT *, sum(n) OVER (PARTITION BY column_name) AS t, sum(n) OVER (PARTITION BY column_name, x) AS nx, sum(n) OVER (PARTITION BY column_name, y) AS ny FROM mi_cells)
    GROUP BY 1""", dbl="mutual_information", views="mi_cells"))
def mutual_info(spark, sf):
    return selection.mutual_information(B.history(spark, sf), _SEL8, LABEL)


@query("lasso_select")
def lasso_select(spark, sf):
    """Weights of all 81 features."""
    frame, features = _frame(spark, sf)
    return selection.lasso(frame, features, LABEL)


@query("recursive_select")
def recursive_select(spark, sf):
    """Every step of the elimination from 81 features down to one."""
    frame, features = _frame(spark, sf)
    return selection.recursive(frame, features, LABEL)


def _parts_sql(name, label, cuts):
    """Counts of exact shares: a part ends at the floor of its cumulated share."""
    edges = ["0"] + [f"floor(n * {c} + 1e-9)" for c in cuts] + ["n"]
    return " UNION ALL ".join(f"SELECT '{name}' AS method, label, '{p}' AS part, ({b} - {a})::BIGINT AS records FROM (SELECT {label} AS label, count(*) AS n FROM history GROUP BY 1)"
                              for p, a, b in zip(("train", "validation", "test"), edges, edges[1:]))


@query("stratified_split", out(f"""
    {_parts_sql('random', 'NULL::INTEGER', (0.7, 0.85))} UNION ALL {_parts_sql('stratified', 'will_fail_7days', (0.7, 0.85))}""", views="history"))
def stratified_split(spark, sf):
    """Rows by part, as a whole and for each class."""
    d = B.history(spark, sf).select(*KEY, LABEL)
    count = F.count(F.lit(1)).alias("records")
    plain = prepare.split(d, "random", KEY).groupBy(F.lit("random").alias("method"), F.lit(None).cast("int").alias("label"), F.col("split").alias("part")).agg(count)
    return plain.unionByName(prepare.split(d, "stratified", KEY, LABEL).groupBy(F.lit("stratified").alias("method"), F.col(LABEL).alias("label"), F.col("split").alias("part")).agg(count))


@query("k_fold", out("""
    SELECT fold::INTEGER AS fold, will_fail_7days AS label, role, CASE WHEN role = 'test' THEN t ELSE n - t END AS records FROM (
        SELECT will_fail_7days, fold, n, (floor(n * fold / 5 + 1e-9) - floor(n * (fold - 1) / 5 + 1e-9))::BIGINT AS t
        FROM (SELECT will_fail_7days, count(*) AS n FROM history GROUP BY 1), range(1, 6) f(fold)), (VALUES ('train'), ('test')) r(role)""", views="history"))
def k_fold(spark, sf):
    d = B.history(spark, sf).select(*KEY, LABEL)
    return prepare.cross_validation(d, "stratified_k_fold", KEY, LABEL).groupBy("fold", F.col(LABEL).alias("label"), "role").agg(F.count(F.lit(1)).alias("records"))


# --------------------------------------------------------------------- models

def _frame(spark, sf):
    """(rows, names of the 81 features): the engineered daily set over seven years, staged once, for model fitting passes over it many times."""
    rows, features, target = prepare.training_set(gold.gold_daily(B.history(spark, sf), in_batches=True, order=["cycle"]))
    return staged(rows.select(*KEY, *features, target)), features


def _parts(spark, sf):
    """The split is a condition on the date: made at each pass over the staged rows, which aren't written a second time."""
    frame, features = _frame(spark, sf)
    split = prepare.time_split(frame)
    return prepare.weighted(split.where("split = 'train'").drop("split"), LABEL), split.where("split = 'test'").drop("split"), features


def _fit_and_score(spark, sf, kind, params=None):
    fit_on, test, features = _parts(spark, sf)
    return train.score(train.fit(fit_on, features, LABEL, kind, params, "weight"), test).select(*KEY, LABEL, "failure_probability", "prediction")


@query("model_lr")
def model_lr(spark, sf):
    return _fit_and_score(spark, sf, "logistic_regression", {"max_iter": 100})


@query("model_dt")
def model_dt(spark, sf):
    return _fit_and_score(spark, sf, "decision_tree", {"max_depth": 10})


@query("model_rf")
def model_rf(spark, sf):
    return _fit_and_score(spark, sf, "random_forest", {"n_estimators": 50, "max_depth": 10, "min_samples_leaf": 2})


@query("model_gbt")
def model_gbt(spark, sf):
    return _fit_and_score(spark, sf, "xgboost", {"n_estimators": 30, "max_depth": 3})


@query("experiment")
def experiment(spark, sf):
    """Two runs, appended to a log and read back: parameters, counts, ratio, hash of the data and metrics."""
    log = work_dir(spark)
    frame = _frame(spark, sf)[0]
    with scratch(spark):
        train.experiment(frame, "logistic_regression", params={"max_iter": 50}, log=log, run_id="time_based", kept=True)
    with scratch(spark):
        train.experiment(frame, "decision_tree", params={"max_depth": 6}, split={"method": "stratified"}, log=log, run_id="stratified", kept=True)
    named = train.runs(spark, log)
    return named.select("run_id", "model", "parameters", "imbalance_method", "n_train_samples", "n_validation_samples", "n_test_samples", "n_features",
                        "class_imbalance_ratio", "dataset_hash", "dataset", F.col("metrics")["f1_score"].alias("f1_score"), F.col("metrics")["roc_auc"].alias("roc_auc"), "promote")


@query("batch_scoring")
def batch_scoring(spark, sf):
    fit_on, test, features = _parts(spark, sf)
    model = train.fit(fit_on, features, LABEL, "logistic_regression", {"max_iter": 50}, "weight")
    path = work_dir(spark)
    model.write().overwrite().save(path + "-model")
    return train.batch_scoring(spark, train.load(path + "-model"), test, path, model_id="logistic_regression")


@query("tune")
def tune(spark, sf):
    space = train.grid({"C": [0.1, 1.0], "max_iter": [20, 40]}, tries=3)
    frame, features = _frame(spark, sf)
    return train.tune(frame, features, LABEL, "logistic_regression", space, folds=3)


@query("tune_bayesian")
def tune_bayesian(spark, sf):
    """Four trials of boosted trees in a space of 36, from a table that a restart goes on with."""
    frame, features = _frame(spark, sf)
    space = {"n_estimators": [3, 5, 8], "max_depth": [2, 3, 4], "learning_rate": [0.01, 0.05, 0.1, 0.3]}
    return train.bayesian_search(frame, features, LABEL, "xgboost", work_dir(spark), 4, space, folds=2, start=2)


@query("perm_importance")
def perm_importance(spark, sf):
    fit_on, test, features = _parts(spark, sf)
    model = train.fit(fit_on, features, LABEL, "logistic_regression", {"max_iter": 50}, "weight")
    return train.permutation_importance(model, test, features, LABEL, KEY)


@query("shap_importance")
def shap_importance(spark, sf):
    """The 20 features that add most to the scores of boosted trees, over all test rows."""
    fit_on, test, features = _parts(spark, sf)
    model = train.fit(fit_on, features, LABEL, "xgboost", {"n_estimators": 20, "max_depth": 4}, "weight")
    return shap.shap_importance(model, test, features, KEY)


@query("smote")
def smote(spark, sf):
    """Class counts and means before and after adding synthetic rows."""
    frame, features = _frame(spark, sf)
    made = prepare.smote(frame, features, LABEL, KEY)
    return made.groupBy(LABEL, "is_synthetic").agg(F.count(F.lit(1)).alias("records"), *[F.avg(c).alias(f"mean_{c}") for c in features])


@query("resample", out("""
    SELECT method, label, CASE WHEN method = 'under' THEN least(p, q) ELSE greatest(p, q) END AS records
    FROM (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label <> 1) AS q FROM scored), (VALUES ('under'), ('over')) m(method),
        (SELECT DISTINCT label FROM scored)""", big="records", views="scored"))
def resample(spark, sf):
    d = B.scored(spark, sf)
    made = None
    for m in ("under", "over"):
        one = prepare.resample(d, "label", ["aircraft_id", "prediction_date"], m, 1.0).groupBy(F.lit(m).alias("method"), "label").agg(F.count(F.lit(1)).alias("records"))
        made = one if made is None else made.unionByName(one)
    return made


@query("iso_forest")
def iso_forest(spark, sf):
    frame, features = _frame(spark, sf)
    return forest.score_forest(frame.drop(LABEL), features, forest.fit_forest(frame, features, KEY)).select(*KEY, "anomaly_score", "is_anomaly")
