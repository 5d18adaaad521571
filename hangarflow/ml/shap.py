"""SHAP values of stored trees: what each feature adds to one row's score.

Path-dependent tree SHAP: a feature that isn't known is followed to both children, by their share of the training rows.
For a leaf, the features on its path either let the row through (o = 1) or not, and without the feature the path keeps the share z
of the rows. Over all orders of the features, the Shapley value of feature i at a leaf of value v is

    v * (o_i - z_i) * sum over k of k! (d - 1 - k)! / d! * [t^k] of the product over j <> i of (z_j + o_j t)

The product of all factors is made once for a leaf, for all rows of an Arrow batch together, and the factor of each feature
divided out again. The trees come from the stored model and go to the tasks as one broadcast, of the size of the model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from hangarflow.session import work_dir


class Leaf:
    """A leaf of a tree: value, and for each feature on its path the share of rows it keeps and the interval (low, high] it asks for."""

    def __init__(self, value: float, path: dict[int, tuple[float, float, float]]):
        self.value, self.features = value, list(path)
        self.share = np.array([p[0] for p in path.values()])
        self.low, self.high = np.array([p[1] for p in path.values()]), np.array([p[2] for p in path.values()])
        d = len(path)
        self.weights = np.array([math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)])

    def add(self, x: np.ndarray, out: np.ndarray) -> None:
        """Add the leaf's part of the values of rows ``x`` to ``out``."""
        d = len(self.features)
        if not d or not self.value:
            return
        own = x[:, self.features].T
        through = ((own > self.low[:, None]) & (own <= self.high[:, None])).astype(float)
        product = np.zeros((d + 1, len(x)))
        product[0] = 1.0
        for z, o in zip(self.share, through):
            more = product * z
            more[1:] += product[:-1] * o
            product = more
        outside = -self.value * (self.weights @ product[:d])
        for i, f in enumerate(self.features):
            rest, inside = np.zeros(len(x)), np.zeros(len(x))
            for k in range(d, 0, -1):
                rest = product[k] - self.share[i] * rest
                inside += self.weights[k - 1] * rest
            out[:, f] += np.where(through[i] > 0, self.value * (1 - self.share[i]) * inside, outside)


def leaves(nodes: dict[int, tuple], weight: float) -> tuple[list[Leaf], float]:
    """The leaves of one tree and its expected value; nodes: id -> (value, rows, feature or -1, threshold, left, right)."""
    out, base, left = [], 0.0, [(0, 1.0, {})]
    while left:
        at, share, path = left.pop()
        value, rows, feature, threshold, a, b = nodes[at]
        if feature < 0:
            out.append(Leaf(weight * value, path))
            base += weight * value * share
            continue
        z, low, high = path.get(feature, (1.0, -math.inf, math.inf))
        for child, bounds in ((a, (low, min(high, threshold))), (b, (max(low, threshold), high))):
            part = nodes[child][1] / rows
            left.append((child, share * part, {**path, feature: (z * part, *bounds)}))
    return out, base


def stored_trees(model, spark: SparkSession) -> tuple[list[Leaf], float]:
    """(leaves of all trees, expected score) of a fitted tree model; read from its stored form."""
    path = work_dir(spark)
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    node = "nodeData" if "nodeData" in data.columns else None
    rows = data.select(F.col("treeID") if node else F.lit(0).alias("treeID"), *([f"{node}.*"] if node else data.columns)).collect()
    margin = hasattr(model, "treeWeights") and "GBT" in type(model).__name__
    trees: dict[int, dict[int, tuple]] = {}
    for r in rows:
        split, stats = r["split"], r["impurityStats"]
        if r["leftChild"] >= 0 and split["numCategories"] >= 0:
            raise ValueError("splits on categories aren't supported")
        value = r["prediction"] if margin else stats[1] / sum(stats) if len(stats) > 1 and sum(stats) else float(r["prediction"])
        inner = r["leftChild"] >= 0
        trees.setdefault(r["treeID"], {})[r["id"]] = (
            value, r["rawCount"], split["featureIndex"] if inner else -1, split["leftCategoriesOrThreshold"][0] if inner else 0.0, r["leftChild"], r["rightChild"])
    weights = list(model.treeWeights) if margin else [1.0 / len(trees)] * len(trees)
    all_leaves, base = [], 0.0
    for t in sorted(trees):
        own, expected = leaves(trees[t], weights[t])
        all_leaves, base = all_leaves + own, base + expected
    return all_leaves, base


def shap_values(model: PipelineModel, df: DataFrame, features: Sequence[str], key: Sequence[str]) -> DataFrame:
    """(key, base, score, shap): one value for each feature; ``base`` and they add up to ``score``.

    The score of a forest or a tree is its probability of class 1, that of boosted trees the margin. A linear model's values are its
    weights times the distance from the mean, about the score of the mean, in log odds.
    """
    last = model.stages[-1]
    plain = PipelineModel(model.stages[:-1]).transform(df).select(*key, vector_to_array("features").alias("_x"))
    if hasattr(last, "coefficients"):
        weights = F.array(*map(F.lit, map(float, last.coefficients)))
        made = plain.select(*key, F.lit(float(last.intercept)).alias("base"), F.zip_with("_x", weights, lambda x, w: x * w).alias("shap"))
        return made.select(*key, "base", (F.col("base") + F.aggregate("shap", F.lit(0.0), lambda s, v: s + v)).alias("score"), "shap")
    trees, base = stored_trees(last, df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast([(t.value, dict(zip(t.features, zip(t.share, t.low, t.high)))) for t in trees])
    kinds = {f.name: f.dataType.simpleString() for f in plain.schema.fields}

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = [Leaf(v, p) for v, p in shared.value]
        for batch in batches:
            if len(batch):
                x = np.vstack(batch["_x"].to_numpy())
                out = np.zeros(x.shape)
                for leaf in own:
                    leaf.add(x, out)
                yield batch[list(key)].assign(base=base, score=base + out.sum(1), shap=list(out))

    return plain.mapInPandas(explain, ", ".join(f"`{c}` {kinds[c]}" for c in key) + ", base double, score double, shap array<double>")


def shap_importance(model: PipelineModel, df: DataFrame, features: Sequence[str], key: Sequence[str], top: int = 20) -> DataFrame:
    """(feature, mean_abs_shap, mean_shap): the ``top`` features by mean absolute value over all rows."""
    values = shap_values(model, df, features, key)
    named = values.select(F.explode(F.zip_with(F.array(*map(F.lit, features)), "shap", lambda n, v: F.struct(n.alias("feature"), v.alias("v")))).alias("s"))
    return named.groupBy("s.feature").agg(F.avg(F.abs("s.v")).alias("mean_abs_shap"), F.avg("s.v").alias("mean_shap")).orderBy(
        F.desc("mean_abs_shap"), "feature").limit(top)


def built_in_importance(model: PipelineModel, features: Sequence[str], spark, top: int = 20) -> DataFrame:
    """(feature, importance): the model's own, gain of a tree's splits or absolute weights, adding up to 1."""
    last = model.stages[-1]
    raw = np.abs(np.array(last.coefficients)) if hasattr(last, "coefficients") else last.featureImportances.toArray()
    total = raw.sum() or 1.0
    best = sorted(zip(features, (raw / total).tolist()), key=lambda x: (-x[1], x[0]))[:top]
    return spark.createDataFrame(best, "feature string, importance double")
