"""Fitting, tuning, scoring and explaining failure classifiers with Spark ML."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from hangarflow import rules
from hangarflow.ml import evaluate, prepare
from hangarflow.operators import decisions
from hangarflow.session import staged, work_dir

KINDS = ["logistic_regression", "decision_tree", "random_forest", "xgboost"]
SEED = 42


def classifier(kind: str, label: str, weight: str | None, rows: int, params: Mapping | None = None):
    """The estimator for a model name, with the published defaults; ``params`` use the same names as before the move."""
    p = dict(params or {})
    common = {"labelCol": label, "featuresCol": "features"}
    if weight:
        common["weightCol"] = weight
    if kind == "logistic_regression":
        # An L2 penalty of C = 1 on the summed loss is 1/n on the mean loss.
        return LogisticRegression(maxIter=p.get("max_iter", 1000), regParam=1.0 / (p.get("C", 1.0) * max(rows, 1)),
                                  elasticNetParam=0.0, standardization=False, **common)
    if kind == "decision_tree":
        return DecisionTreeClassifier(maxDepth=p.get("max_depth", 30), minInstancesPerNode=p.get("min_samples_leaf", 1),
                                      seed=SEED, **common)
    if kind == "random_forest":
        return RandomForestClassifier(
            numTrees=p.get("n_estimators", 100), maxDepth=p.get("max_depth") or 30,
            minInstancesPerNode=max(p.get("min_samples_leaf", 1), (p.get("min_samples_split", 2) + 1) // 2 if "min_samples_leaf" not in p else 1),
            featureSubsetStrategy=p.get("max_features", "sqrt"), seed=SEED, **common)
    if kind == "xgboost":
        return GBTClassifier(maxIter=p.get("n_estimators", 100), maxDepth=p.get("max_depth", 6), stepSize=p.get("learning_rate", 0.1),
                             subsamplingRate=p.get("subsample", 0.8), featureSubsetStrategy=str(p.get("colsample_bytree", "all")), seed=SEED, **common)
    raise ValueError(f"unknown model type {kind!r}")


def fit(train: DataFrame, features: Sequence[str], label: str, kind: str = "random_forest", params=None,
        weight: str | None = None) -> PipelineModel:
    """The stages assemble, scale and classify, fitted one after the other.

    For fitting, the columns become a vector, and a scaled one, in one compiled projection each; as stages of a fitted
    pipeline they would turn each row into objects and back at every pass. What comes out is the same pipeline.
    """
    known = train.dropna(subset=list(features))  # as the assembler skips them
    values = [F.col(c).cast("double") for c in features]
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True).fit(
        known.select(array_to_vector(F.array(*values)).alias("raw_features")))
    mean, std = scaler.mean.toArray().tolist(), scaler.std.toArray().tolist()
    scaled = F.array(*[(v - F.lit(m)) * F.lit(1 / s if s else 0.0) for v, m, s in zip(values, mean, std)])
    ready = known.select(label, *([weight] if weight else []), array_to_vector(scaled).alias("features"))
    made = classifier(kind, label, weight, train.count(), params).fit(ready)
    assembler = VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="skip")
    # Saved and loaded: the model outlives the session, and scoring does not drag the
    # training summary (with its DataFrame and session) into every task.
    path = work_dir(train.sparkSession)
    PipelineModel([assembler, scaler, made]).write().save(path)
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, out: str = "failure_probability") -> DataFrame:
    """Probability of class 1 and the 0/1 prediction."""
    got = model.transform(df)
    return got.select(*df.columns, vector_to_array("probability")[1].alias(out), F.col("prediction").cast("int").alias("prediction"))


RUNS = ("run_id string, model string, parameters string, imbalance_method string, n_train_samples long, n_validation_samples long, n_test_samples long, "
        "n_features int, class_imbalance_ratio double, dataset_hash string, dataset string, metrics map<string, double>, promote boolean")


def experiment(df: DataFrame, kind: str, use_smote: bool = False, params=None, use_engineered: bool = True,
               keep: Sequence[str] = ("aircraft_id", "date"), split: Mapping | None = None, log: str | None = None, run_id: str = "run", kept: bool = False):
    """Prepare, split, balance, fit and evaluate. Returns (model, metric rows for validation and test, scored test rows).

    With ``log`` (a folder) the run is appended there, a row for each data set: parameters, counts, ratio of rows to failures in the training part,
    the order-free hash of the prepared rows, metrics and the gate's answer; :func:`runs` reads it.
    ``kept``: ``df`` is read from storage, so a split by time, a condition on the date, is made at each pass instead of writing all rows again.
    """
    rows, features, target = prepare.training_set(df, use_engineered)
    split = dict(split or {})
    parts = prepare.split(rows.select(*keep, *features, target), key=keep, label=target, **split)
    if not kept or split.get("method", "time_based") != "time_based":
        parts = staged(parts)
    train = parts.where("split = 'train'")
    method = "smote" if use_smote else "class_weight"
    if use_smote:
        balanced, weight = staged(prepare.smote(train, features, target, list(keep))), None
    else:
        balanced, weight = prepare.weighted(train, target), "weight"
    model = fit(balanced, features, target, kind, params, weight)
    made = None
    for part in ("validation", "test"):
        # The curves read the scores several times: scored once, and only what they read is kept.
        scored = staged(score(model, parts.where(F.col("split") == part)).select(target, "failure_probability", "prediction"))
        one = evaluate.metrics(scored, target).select(F.lit(kind).alias("model"), F.lit(part).alias("dataset"), "*")
        made = one if made is None else made.unionByName(one)
    gated = staged(evaluate.promotion_gate(made))
    if log:
        _log_run(gated, parts, features, target, method, params, log, run_id)
    return model, gated, score(model, parts.where("split = 'test'"))


def _log_run(gated: DataFrame, parts: DataFrame, features, target: str, method: str, params, log: str, run_id: str) -> None:
    n = lambda part: F.count_if(F.col("split") == part)
    train = F.col("split") == "train"
    about = parts.agg(F.struct(
        n("train").alias("a"), n("validation").alias("b"), n("test").alias("c"),
        F.try_divide(n("train"), F.count_if(train & (F.col(target) == 1))).alias("r")).alias("s")).scalar()
    hashed = decisions.fingerprint(parts).select(F.concat_ws("-", "rows", "hash_xor", "hash_low", "hash_high")).scalar()
    measured = ["precision", "recall", "f1_score", "accuracy", "false_positive_rate", "roc_auc", "average_precision"]
    row = gated.withColumn("_s", about).withColumn("_h", hashed).select(
        F.lit(run_id).alias("run_id"), "model", F.lit(json.dumps(dict(params or {}), sort_keys=True)).alias("parameters"), F.lit(method).alias("imbalance_method"),
        F.col("_s.a").alias("n_train_samples"), F.col("_s.b").alias("n_validation_samples"), F.col("_s.c").alias("n_test_samples"),
        F.lit(len(features)).alias("n_features"), F.col("_s.r").alias("class_imbalance_ratio"), F.col("_h").alias("dataset_hash"), "dataset",
        F.create_map(*[x for m in measured for x in (F.lit(m), F.col(m).cast("double"))]).alias("metrics"), "promote")
    row.coalesce(1).write.mode("append").parquet(log)


def runs(spark: SparkSession, log: str) -> DataFrame:
    """The experiment rows of a log."""
    return spark.read.schema(RUNS).parquet(log)


def grid(space: Mapping[str, Iterable], tries: int | None = None, seed: int = SEED) -> list[dict]:
    """All combinations, or ``tries`` of them drawn at random (random search)."""
    full = [dict(zip(space, values)) for values in product(*space.values())]
    return full if tries is None or tries >= len(full) else random.Random(seed).sample(full, tries)


def _folded(df: DataFrame, ts: str, folds: int, gap: int) -> DataFrame:
    return staged(prepare.ts_folds(df, ts, folds, gap))


def _fold_scores(folded: DataFrame, features, label: str, kind: str, jobs: Sequence[tuple[int, dict, int]], balanced: bool, parallel: int) -> list[tuple[int, int, float]]:
    """(trial, fold, F1) of each (trial, params, fold); class weights come from the fold's own training rows. Fits run side by side."""
    def one(job):
        i, params, fold = job
        mine = folded.where(F.col("fold") == fold)
        train = mine.where("role = 'train'")
        model = fit(prepare.weighted(train, label) if balanced else train, features, label, kind, params, "weight" if balanced else None)
        return i, fold, evaluate.metrics(score(model, mine.where("role = 'test'")), label, prob=None).first()["f1_score"]

    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(one, jobs))


def tune(df: DataFrame, features, label: str, kind: str, candidates: Sequence[dict], ts: str = "date", folds: int = 5,
         balanced: bool = True, gap: int = rules.SPLIT_GAP, parallel: int = 4) -> DataFrame:
    """Mean F1 of each candidate over expanding time folds, ``gap`` dates between a fold's parts."""
    folded = _folded(df, ts, folds, gap)
    results = _fold_scores(folded, features, label, kind, [(i, p, f) for i, p in enumerate(candidates) for f in range(1, folds + 1)], balanced, parallel)
    rows = [(i, str(sorted(candidates[i].items())), fold, f1) for i, fold, f1 in results]
    per = df.sparkSession.createDataFrame(rows, "candidate int, params string, fold int, f1_score double")
    return per.groupBy("candidate", "params").agg(F.avg("f1_score").alias("mean_f1"), F.count(F.lit(1)).alias("folds"))


#: The search spaces of the forest and of boosting.
SPACES = {
    "random_forest": {"n_estimators": [50, 100, 200, 300], "max_depth": [10, 20, 30, None], "min_samples_split": [2, 5, 10],
                      "min_samples_leaf": [1, 2, 4], "max_features": ["sqrt", "log2"]},
    "xgboost": {"n_estimators": [100, 200, 300], "max_depth": [3, 6, 9], "learning_rate": [0.01, 0.05, 0.1, 0.3],
                "subsample": [0.7, 0.8, 0.9], "colsample_bytree": [0.7, 0.8, 0.9]},
}
TRIALS = "trial int, params string, fold int, f1_score double"


def _encoded(space: Mapping[str, Sequence], params: Mapping) -> list[float]:
    """Each parameter by the place of its value in the space, 0 to 1."""
    return [list(v).index(params[k]) / max(1, len(v) - 1) for k, v in space.items()]


def expected_improvement(seen: np.ndarray, values: np.ndarray, open_: np.ndarray, reach: float = 0.5, noise: float = 1e-4) -> np.ndarray:
    """Of each open point, under a Gaussian process through the seen ones (squared exponential, values standardised)."""
    kernel = lambda a, b: np.exp(-((a[:, None] - b[None]) ** 2).sum(-1) / (2 * reach**2))
    spread = values.std() or 1.0
    y = (values - values.mean()) / spread
    solve = np.linalg.solve(kernel(seen, seen) + noise * np.eye(len(seen)), np.hstack([y[:, None], kernel(seen, open_)]))
    across = kernel(open_, seen)
    mean, var = across @ solve[:, 0], 1 - np.einsum("ij,ji->i", across, solve[:, 1:])
    std = np.sqrt(np.maximum(var, 1e-12))
    z = (mean - y.max()) / std
    cdf = 0.5 * (1 + np.vectorize(math.erf)(z / math.sqrt(2)))
    return spread * std * (z * cdf + np.exp(-z * z / 2) / math.sqrt(2 * math.pi))


def next_trial(space: Mapping[str, Sequence], done: Mapping[str, float], start: int, seed: int) -> dict | None:
    """The parameters to try next, None if all are done. The first ``start`` are drawn at random, the same on every call; ties go to the first of the grid."""
    every = {json.dumps(p, sort_keys=True): p for p in grid(space)}
    left = [k for k in every if k not in done]
    if not left:
        return None
    if len(done) < start:
        return every[random.Random(f"{seed}-{len(done)}").choice(left)]
    seen = np.array([_encoded(space, every[k]) for k in done])
    gain = expected_improvement(seen, np.array(list(done.values())), np.array([_encoded(space, every[k]) for k in left]))
    return every[left[int(gain.argmax())]]


def bayesian_search(df: DataFrame, features, label: str, kind: str, path: str, trials: int, space: Mapping[str, Sequence] | None = None, ts: str = "date",
                    folds: int = 5, balanced: bool = True, gap: int = rules.SPLIT_GAP, start: int = 5, seed: int = SEED, parallel: int = 4) -> DataFrame:
    """(trial, params, mean_f1, folds) after ``trials`` trials, each chosen by its expected improvement on those before.

    Trials are rows appended to the table at ``path``, all folds of a trial in one write; a search started again with the same path goes on
    after the trials that are there, and chooses as the broken-off one would have.
    """
    spark = df.sparkSession
    space = space or SPACES[kind]
    spark.createDataFrame([], TRIALS).write.mode("append").parquet(path)
    folded = _folded(df, ts, folds, gap)
    while True:
        past = spark.read.schema(TRIALS).parquet(path).groupBy("trial", "params").agg(F.avg("f1_score").alias("f1")).orderBy("trial").collect()
        params = next_trial(space, {r["params"]: r["f1"] for r in past}, start, seed) if len(past) < trials else None
        if params is None:
            break
        at = len(past)
        got = _fold_scores(folded, features, label, kind, [(at, params, f) for f in range(1, folds + 1)], balanced, parallel)
        text = json.dumps(params, sort_keys=True)
        spark.createDataFrame([(at, text, fold, f1) for _, fold, f1 in got], TRIALS).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(TRIALS).parquet(path).groupBy("trial", "params").agg(F.avg("f1_score").alias("mean_f1"), F.count(F.lit(1)).alias("folds"))


def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str], label: str, key: Sequence[str], top: int = 20, seed: int = SEED) -> DataFrame:
    """Loss of accuracy and F1 when one feature is shuffled over all rows.

    Rows are numbered by hash, a keyed permutation of the numbers says whose values a row takes, and one join by number
    brings them. All features are shuffled in that pass, each variant with one of them, and every variant
    is scored in one run of the model.
    """
    placed = staged(prepare.numbered(df.select(*key, *features, label), key, seed, "_at"))
    n = placed.count()
    values = F.array(*[F.col(c).cast("double") for c in features])
    giving = placed.select(F.col("_at").alias("_from"), values.alias("_p"))
    mixed = placed.withColumn("_from", prepare.permuted(F.col("_at"), F.lit(max(1, n)), seed)).select(label, "_from", values.alias("_x")).join(giving, "_from")
    # Variant 0 is the row as it is, variant i takes feature i from the other row.
    each = mixed.select(label, "_x", "_p", F.explode(F.sequence(F.lit(0), F.lit(len(features)))).alias("_k"))
    wide = each.select(label, F.get(F.array(F.lit(""), *map(F.lit, features)), F.col("_k")).alias("feature"),
                       *[F.when(F.col("_k") == i, F.col("_p")[i - 1]).otherwise(F.col("_x")[i - 1]).alias(c) for i, c in enumerate(features, 1)])
    got = staged(evaluate.metrics(score(model, wide), label, prob=None, by="feature"))
    base = got.where("feature = ''").select(F.struct("accuracy", "f1_score").alias("b")).scalar()
    return got.where("feature <> ''").withColumn("_b", base).select(
        "feature", (F.col("_b.f1_score") - F.col("f1_score")).alias("f1_drop"),
        (F.col("_b.accuracy") - F.col("accuracy")).alias("accuracy_drop"),
    ).orderBy(F.desc("f1_drop"), "feature").limit(top)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def batch_scoring(spark: SparkSession, model: PipelineModel, df: DataFrame, path: str, **about) -> DataFrame:
    """Score, add risk and window columns, write the predictions file and read it back."""
    from hangarflow.operators import decisions

    scored = score(model, df).withColumnRenamed("date", "prediction_date")
    decisions.predictions(scored, **about).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
