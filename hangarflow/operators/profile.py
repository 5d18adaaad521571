"""Profiling and KPI aggregates; one pass per table, no per-column jobs."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window, functions as F

from hangarflow import rules
from hangarflow.functions.scalars import divide
from hangarflow.operators.ordered import names, per_entity
from hangarflow.operators.quantiles import exact_quantiles


def value_distribution(df, col: str) -> DataFrame:
    """Count and share of each value; the total comes from the grouped counts."""
    counted = df.groupBy(col).agg(F.count(F.lit(1)).alias("records"))
    total = counted.agg(F.sum("records")).scalar()
    return counted.select(F.col(col).cast("string").alias("value"), "records",
                          (divide(F.col("records"), total)).alias("share"))


def describe(df, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column."""
    one = df.agg(*[
        F.struct(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                 F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(c) for c in cols
    ])
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    long = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("s")) for c in cols])).alias("r")).select("r.column_name", "r.s.*")
    quart = q.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c)[0].alias("p25"), F.col(c)[1].alias("p50"),
                 F.col(c)[2].alias("p75")) for c in cols])).alias("r")).select("r.*")
    return long.join(quart, "column_name")


def correlations(df, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair in one aggregate, as a long table."""
    pairs = list(combinations(cols, 2))
    one = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("left_column"), F.lit(b).alias("right_column"), F.col(f"c{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ])).alias("r")).select("r.*")


def correlation_matrix(df, cols) -> DataFrame:
    half = correlations(df, cols)
    other = half.select(F.col("right_column").alias("left_column"), F.col("left_column").alias("right_column"), "correlation")
    diag = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, cols))).alias("left_column"))
    diag = diag.select("left_column", F.col("left_column").alias("right_column"), F.lit(1.0).alias("correlation"))
    return half.unionByName(other).unionByName(diag)


def correlation_rank(df, cols, target: str, top: int = 10) -> DataFrame:
    """Columns by absolute correlation with the target."""
    one = df.agg(*[F.corr(c, target).alias(c) for c in cols])
    long = one.unpivot([], list(cols), "column_name", "correlation")
    return long.select("column_name", "correlation", F.abs("correlation").alias("strength")) \
        .orderBy(F.desc_nulls_last("strength"), "column_name").limit(top)


def histogram(df, col: str, bins: int, by=()) -> DataFrame:
    """Equal-width bins over the column's whole range, counted per class; the maximum folds into the last bin."""
    by = names(by) if by else []
    edge = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("e")).scalar()
    known = df.where(F.col(col).isNotNull()).withColumn("_e", edge)
    width = (F.col("_e.hi") - F.col("_e.lo")) / bins
    spot = F.least(F.lit(bins - 1), F.coalesce(F.floor(F.try_divide(F.col(col) - F.col("_e.lo"), width)), F.lit(0)))
    return known.groupBy(*by, spot.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("records"),
        F.min(F.col("_e.lo") + spot * width).alias("bin_start"),
    )


def life_stats(df, by="engine_id", cycle="cycle", tag=None) -> DataFrame:
    """Lives per entity, then their spread: two grouping levels."""
    tags = [tag] if tag else []
    lives = df.groupBy(*tags, by).agg(F.max(cycle).alias("life"), F.count(F.lit(1)).alias("n"))
    return lives.groupBy(*tags).agg(
        F.count(F.lit(1)).alias("engines"), F.sum("n").alias("records"), F.min("life").alias("min_life"),
        F.max("life").alias("max_life"), F.avg("life").alias("avg_life"), F.stddev_samp("life").alias("std_life"),
    )


def dataset_compare(df, tag="dataset", by="engine_id", cycle="cycle", within=rules.RUL_CYCLES) -> DataFrame:
    """Records, engines, mean life and failure rate (share of rows within N cycles of the end) per dataset; cycles may be missing."""
    known = per_entity(df.select(tag, by, cycle), [tag, by], {"_life": F.max(cycle)})
    lives = known.groupBy(tag, by).agg(
        F.max("_life").alias("life"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("_life") - F.col(cycle) <= within).alias("late"))
    return lives.groupBy(tag).agg(
        F.sum("n").alias("records"), F.count(F.lit(1)).alias("engines"), F.avg("life").alias("avg_cycles"),
        (100 * divide(F.sum("late"), F.sum("n"))).alias("failure_rate"),
    )


def cost_analysis(df, kind="maintenance_type", cost="cost_usd") -> DataFrame:
    per = df.groupBy(kind).agg(F.count(F.lit(1)).alias("events"), F.sum(cost).alias("total_cost"), F.avg(cost).alias("avg_cost"))
    total = per.agg(F.sum("total_cost")).scalar()
    return per.select(kind, "events", "total_cost", "avg_cost", (100 * F.try_divide("total_cost", total)).alias("cost_share_pct"))


def stock_summary(df, part="part_number", level="quantity_on_hand", reorder="reorder_point") -> DataFrame:
    """Mean stock, reorder point and days below it; strictly below counts."""
    return df.groupBy(part).agg(
        F.avg(level).alias("avg_stock"), F.min(reorder).alias("reorder_point"),
        F.count_if(F.col(level) < F.col(reorder)).alias("stock_outs"), F.count(F.lit(1)).alias("snapshots"),
    )


def window_stats(readings, window: str, keys=("aircraft_id", "sensor_type"), ts="measurement_timestamp",
                 value="measurement_value") -> DataFrame:
    """Tumbling-window statistics; weeks start on the epoch day."""
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return readings.groupBy(*keys, F.window(ts, window).alias("w")).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
        F.max(value).alias("max"), q.alias("q"),
    ).select(*keys, F.col("w.start").alias("window_start"), F.lit(window).alias("window"), "mean", "std", "min", "max",
             F.col("q")[1].alias("median"), F.col("q")[0].alias("percentile_25"), F.col("q")[2].alias("percentile_75"))


def daily_summary(readings, keys=("aircraft_id", "sensor_type"), ts="measurement_timestamp", value="measurement_value") -> DataFrame:
    return readings.groupBy(*keys, F.to_date(ts).alias("date")).agg(
        F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("avg"), F.stddev_samp(value).alias("std"))


def maintenance_kpis(failures, maintenance, days_observed: int, by="aircraft_id") -> DataFrame:
    """MTBF (days), MTTR (hours) and failures per observed day, per aircraft.

    The mean gap between successive failures telescopes to (last - first) / (n - 1),
    so no ordered scan is needed.
    """
    f = failures.groupBy(by).agg(
        F.count(F.lit(1)).alias("failures"), F.min("failure_ts").alias("_a"), F.max("failure_ts").alias("_b"))
    m = maintenance.groupBy(by).agg(
        F.avg(F.when(F.col("maintenance_type") == "corrective", F.col("downtime_hours"))).alias("mttr_hours"))
    span = (F.unix_micros("_b") - F.unix_micros("_a")) / 86_400_000_000
    return m.join(f, by, "full").select(
        by, F.coalesce("failures", F.lit(0)).alias("failures"),
        F.when(F.col("failures") > 1, span / (F.col("failures") - 1)).alias("mtbf_days"), "mttr_hours",
        (F.coalesce("failures", F.lit(0)) / F.lit(float(days_observed))).alias("failure_rate"),
    )


def inventory_kpis(snapshots, part="part_number", day="snapshot_date", level="quantity_on_hand", reorder="reorder_point") -> DataFrame:
    """Mean level, turnover (issues / mean level) and stock-out incidents per part."""
    step = F.col(level) - F.lag(level).over(Window.partitionBy(part).orderBy(day))  # one row per part and day
    return snapshots.select(part, level, reorder, step.alias("_d")).groupBy(part).agg(
        F.avg(level).alias("avg_level"), divide(-F.sum(F.when(F.col("_d") < 0, F.col("_d"))), F.avg(level)).alias("turnover"),
        F.count_if(F.col(level) < F.col(reorder)).alias("stockout_incidents"),
    )


def fleet_profile(fleet, year: int, made="manufacture_year", by=("model", "location")) -> DataFrame:
    age = F.lit(year) - F.col(made)
    return fleet.groupBy(*by).agg(F.count(F.lit(1)).alias("aircraft"), F.avg(age).alias("avg_age"),
                                  F.min(age).alias("min_age"), F.max(age).alias("max_age"))


def risk_share(scored, p="failure_probability", by="aircraft_id") -> DataFrame:
    """Share of aircraft per level of their highest risk."""
    from hangarflow.functions.scalars import risk_level

    worst = scored.groupBy(by).agg(F.max(p).alias("_p"))
    return value_distribution(worst.select(risk_level(F.col("_p")).alias("risk_level")), "risk_level").withColumnRenamed("value", "risk_level")
