"""Remaining life, failure-within-N labels and warning bands."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hangarflow import rules
from hangarflow.operators.joins import forward_within
from hangarflow.operators.ordered import per_entity


def rul(df: DataFrame, by="engine_id", cycle="cycle") -> DataFrame:
    """Cycles left: last cycle of the entity minus this one."""
    return per_entity(df, by, {"_last": F.max(cycle)}).select(*df.columns, (F.col("_last") - F.col(cycle)).alias("RUL"))


def within(df: DataFrame, cycles: int = rules.RUL_CYCLES) -> DataFrame:
    """0/1 labels from the remaining life, the limit included."""
    return df.select("*", (F.col("RUL") <= cycles).cast("int").alias(f"will_fail_{cycles}_cycles"),
                     (F.col("RUL") == 0).cast("int").alias("failed"))


def failure_within(df, failures, by="aircraft_id", ts="measurement_timestamp", failure_ts="failure_ts",
                   days=rules.HORIZON_DAYS, out="failure_within_7_days") -> DataFrame:
    return forward_within(df, failures, by, ts, failure_ts, days, out)


def failure_band(df, by="aircraft_id", cycle="cycle", failed="failed", width=rules.HORIZON_DAYS) -> DataFrame:
    """First failure cycle of the entity and whether the row lies in the band before it."""
    first = per_entity(df, by, {"failure_cycle": F.min(F.when(F.col(failed) == 1, F.col(cycle)))})
    band = F.col(cycle).between(F.col("failure_cycle") - width, F.col("failure_cycle"))
    return first.withColumn("in_warning_band", F.coalesce(band, F.lit(False)))
