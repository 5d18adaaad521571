"""Drift, performance trend, retraining triggers and the run log."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F

from hangarflow import rules
from hangarflow.functions.scalars import business_key, divide
from hangarflow.ml import evaluate
from hangarflow.operators.ordered import global_running
from hangarflow.operators.quantiles import exact_quantiles


def psi(baseline: DataFrame, current: DataFrame, value: str, by: str, bins: int = 10, eps=rules.PSI_EPSILON,
        threshold=rules.PSI_THRESHOLD) -> DataFrame:
    """Population stability index per feature over baseline quantile bins; empty shares count as ``eps``."""
    probs = [i / bins for i in range(1, bins)]
    cuts = exact_quantiles(baseline, [value], probs, [by]).withColumnRenamed(value, "_cuts")
    both = baseline.select(by, value, F.lit(0).alias("_now")).unionByName(current.select(by, value, F.lit(1).alias("_now")))
    spot = F.size(F.filter("_cuts", lambda c: c < F.col(value)))
    binned = both.where(F.col(value).isNotNull()).join(cuts, by).withColumn("_bin", spot)
    cells = [(b, now) for b in range(bins) for now in (0, 1)]
    counted = binned.groupBy(by).agg(
        *[F.count_if((F.col("_bin") == b) & (F.col("_now") == now)).alias(f"n{b}_{now}") for b, now in cells],
        F.count_if(F.col("_now") == 0).alias("n_0"), F.count_if(F.col("_now") == 1).alias("n_1"))

    def share(b, now):
        return F.greatest(F.coalesce(divide(F.col(f"n{b}_{now}"), F.col(f"n_{now}")), F.lit(0.0)), F.lit(eps))

    total = F.lit(0.0)
    for b in range(bins):
        total = total + (share(b, 1) - share(b, 0)) * F.log(share(b, 1) / share(b, 0))
    return counted.select(by, F.col("n_0").alias("baseline_rows"), F.col("n_1").alias("current_rows"), total.alias("psi"),
                          (total > threshold).alias("drifted"))


def ks(baseline: DataFrame, current: DataFrame, value: str, coefficient: float = 1.358) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic; equal values are counted first, the global order is chunked."""
    both = baseline.select(value, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        current.select(value, F.lit(0).alias("_a"), F.lit(1).alias("_b"))).where(F.col(value).isNotNull())
    per = both.groupBy(value).agg(F.sum("_a").alias("_na"), F.sum("_b").alias("_nb"))
    n = per.agg(F.struct(F.sum("_na").alias("a"), F.sum("_nb").alias("b")).alias("n")).scalar()
    run = global_running(per, value, ["_na", "_nb"]).withColumn("_n", n)
    gap = F.abs(divide(F.col("cum__na"), F.col("_n.a")) - divide(F.col("cum__nb"), F.col("_n.b")))
    limit = coefficient * F.sqrt((F.col("n.a") + F.col("n.b")) / (F.col("n.a") * F.col("n.b")))
    return run.agg(F.max(gap).alias("ks_statistic"), F.first("_n").alias("n")).select(
        F.col("n.a").alias("baseline_rows"), F.col("n.b").alias("current_rows"), "ks_statistic",
        limit.alias("critical_value"), (F.col("ks_statistic") > limit).alias("drifted"))


def performance_trend(scored: DataFrame, day="prediction_date", label="label", pred="prediction", decay=rules.PERF_DECAY) -> DataFrame:
    """Weekly precision, recall and F1, the loss against the first week and the retraining trigger."""
    weekly = evaluate.rates(scored.groupBy(F.date_trunc("week", F.col(day)).cast("date").alias("week")).agg(
        *evaluate.confusion_counts(label, pred)))
    base = weekly.agg(F.min_by("f1_score", "week").alias("b")).scalar()
    with_base = weekly.withColumn("baseline_f1", base)
    degraded = F.col("f1_score") < decay * F.col("baseline_f1")
    return with_base.select("week", "precision", "recall", "f1_score", "baseline_f1", degraded.alias("degraded"))


def retraining(trend: DataFrame, psi_rows: DataFrame, manual: bool = False, scheduled: bool = False) -> DataFrame:
    """Any of: degraded week, drifted feature, manual request, monthly schedule."""
    drifted = psi_rows.agg(F.coalesce(F.bool_or("drifted"), F.lit(False))).scalar()
    out = trend.agg(F.coalesce(F.bool_or("degraded"), F.lit(False)).alias("performance_degradation"))
    out = out.select("performance_degradation", drifted.alias("significant_drift"), F.lit(manual).alias("manual_trigger"),
                     F.lit(scheduled).alias("scheduled_monthly"))
    any_ = F.lit(False)
    for c in out.columns:
        any_ = any_ | F.col(c)
    return out.select("*", any_.alias("retrain"))


RUN_LOG = ("execution_id string, pipeline_name string, pipeline_stage string, duration_seconds double, status string, "
           "records_processed bigint, records_failed bigint, error_message string, input_tables array<string>, "
           "output_table string, feature_version string, within_time_limit boolean")


def logged(df: DataFrame, sink: Callable[[DataFrame], None], log_path: str, pipeline: str, stage: str, run_id: str,
           inputs=(), output="", failed=None, version="1.0") -> None:
    """Run a stage through ``sink`` and append its log row; rows are counted while they are written."""
    spark = df.sparkSession
    seen = Observation(f"{stage}-{run_id}")
    bad = F.count_if(failed if failed is not None else F.lit(False))
    start, status, error = time.time(), "completed", None
    try:
        sink(df.observe(seen, F.count(F.lit(1)).alias("n"), bad.alias("bad")))
    except Exception as e:
        status, error = "failed", str(e)
        raise
    finally:
        got = seen.get if status == "completed" else {}
        took = time.time() - start
        row = spark.range(1).select(
            business_key(F.lit(pipeline), F.lit(stage), F.lit(run_id)).alias("execution_id"), F.lit(pipeline).alias("pipeline_name"),
            F.lit(stage).alias("pipeline_stage"), F.lit(took).alias("duration_seconds"), F.lit(status).alias("status"),
            F.lit(got.get("n")).cast("bigint").alias("records_processed"), F.lit(got.get("bad", 0)).cast("bigint").alias("records_failed"),
            F.lit(error).cast("string").alias("error_message"), F.array(*map(F.lit, inputs)).cast("array<string>").alias("input_tables"),
            F.lit(output).alias("output_table"), F.lit(version).alias("feature_version"),
            F.lit(took <= rules.RUN_MINUTES_MAX * 60).alias("within_time_limit"))
        row.coalesce(1).write.mode("append").parquet(log_path)
