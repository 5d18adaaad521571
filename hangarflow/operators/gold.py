"""Feature tables: the daily set, the aircraft-day set and the training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hangarflow import rules, schemas
from hangarflow.operators import batched, cleaning, joins, quality, windows
from hangarflow.operators.ordered import spread
from hangarflow.operators.quantiles import exact_quantiles
from hangarflow.session import staged


def daily_features(silver: DataFrame, cols=tuple(rules.SENSORS), sizes=tuple(rules.WINDOWS_DAYS),
                   by="aircraft_id", ts="date", in_batches: bool = False) -> DataFrame:
    """All rolling, trend, anomaly and interaction columns in one projection.

    Every window shares the partitioning (and all ordered ones the order), so
    Catalyst plans one exchange for the whole set. ``in_batches`` makes the same columns in Arrow batches
    (:mod:`batched`), at a fraction of the CPU time of as many window expressions.
    """
    cols = [c for c in cols if c in silver.columns]
    if in_batches:
        made = batched.daily(silver, cols, sizes, by, ts, place="cycle" not in silver.columns)
        return made.select("*", *windows.domain_columns([*silver.columns, "cycle"], by, ts))
    return spread(silver, by).select(
        "*", *windows.rolling_columns(cols, sizes, by, ts), *windows.trend_columns(cols, sizes, by, ts),
        *windows.anomaly_columns(cols, by), *windows.domain_columns(silver.columns, by, ts),
    )


def domain(df: DataFrame, by="aircraft_id", ts="date") -> DataFrame:
    return df.select("*", *windows.domain_columns(df.columns, by, ts))


def silver_daily(bronze: DataFrame, cols=tuple(rules.SENSORS), keys=("aircraft_id", "date"), order=None,
                 width=None, copies: bool = False) -> DataFrame:
    """Fill, then cap, then keep the first row per key, in this order.

    For raw files, ``width`` (days) chunks the fill where a key has many rows, and
    ``copies`` first collapses exact copies: they fill alike, only the limits need
    their number, and the first of each key is the same.
    """
    by, ts = keys
    rest = [c for c in bronze.columns if c not in keys]
    rows = cleaning.collapse_copies(bronze) if copies else bronze
    # The limits and the capping both read the filled rows: kept once in the shared folder.
    filled = staged(cleaning.impute(rows, list(cols), "forward_fill", by, ts, order or rest, width))
    measured = cleaning.expand_copies(filled.select(*cols, "_copies")) if copies else filled
    capped = cleaning.outliers(filled.select(*bronze.columns), list(cols), "iqr", rules.IQR_FACTOR, "cap", measured)
    # Without ``width`` an entity's rows were together for filling: so they are dealt for what follows, and not once more.
    return cleaning.keep_first(capped if copies or width else spread(capped, by), list(keys), order or rest)


def gold_daily(bronze: DataFrame, in_batches: bool = False, **kw) -> DataFrame:
    return daily_features(silver_daily(bronze, **kw), in_batches=in_batches)


def run(spark: SparkSession, bronze: str, silver: str, gold: str, fmt: str = "parquet", ranges=None) -> DataFrame:
    """Bronze CSV files to silver and gold tables; one summary row comes back.

    Raw files may hold copies, so these are collapsed and filling is chunked by day. Silver is written
    once and read back, so gold does not repeat the cleaning.
    """
    raw = spark.read.schema(schemas.struct(schemas.DAILY)).option("header", True).csv(bronze)
    scores = quality.score(raw.agg(
        quality.completeness_expr(raw.columns).alias("completeness"),
        quality.validity_expr(ranges or rules.VALID_RANGES, raw.columns).alias("validity"),
    ))
    silver_daily(raw, width=1, copies=True).write.mode("overwrite").format(fmt).option("header", True).save(silver)
    cleaned = spark.read.schema(raw.schema).format(fmt).option("header", True).load(silver)
    features = daily_features(cleaned)
    features.write.mode("overwrite").format(fmt).option("header", True).save(gold)
    written = spark.read.schema(features.schema).format(fmt).option("header", True).load(gold)

    def n(df):
        return df.agg(F.count(F.lit(1))).scalar()

    return scores.select(
        n(raw).alias("bronze_records"), n(cleaned).alias("silver_records"), n(written).alias("gold_records"),
        F.lit(len(raw.columns)).alias("bronze_features"), F.lit(len(features.columns)).alias("gold_features"),
        F.col("overall_score").alias("quality_score"), F.col("passed").alias("quality_passed"),
        F.lit(silver).alias("silver_path"), F.lit(gold).alias("gold_path"),
    )


def anomaly_flag(df: DataFrame, value: str, by: str, contamination=rules.CONTAMINATION) -> DataFrame:
    """Robust deviation per category, squeezed to [0, 1); flagged above the fleet's quantile."""
    # Three numbers per category, used by every later pass: computed once.
    q = staged(exact_quantiles(df, [value], [0.25, 0.5, 0.75], [by]).withColumnRenamed(value, "_q"))
    spread = (F.col("_q")[2] - F.col("_q")[0]) / 1.349
    z = F.abs(F.col(value) - F.col("_q")[1]) / (spread + 1e-6)
    # The limit reads the scores several times, as do callers: scored once.
    scored = staged(df.join(q, by, "left").select(*df.columns, (z / (z + 1)).alias("anomaly_score")))
    limit = exact_quantiles(scored, ["anomaly_score"], [1 - contamination]).select(F.col("anomaly_score")[0]).scalar()
    return scored.withColumn("_limit", limit).select(
        *df.columns, "anomaly_score", (F.col("anomaly_score") > F.col("_limit")).alias("is_anomaly"))


def sensor_hours(readings: DataFrame, maintenance: DataFrame, keys=("aircraft_id", "sensor_id", "sensor_type"), by="aircraft_id",
                 ts="measurement_timestamp") -> DataFrame:
    """The hourly feature table, one row per aircraft, sensor and hour: values, rolling statistics, trends, rates, shape of
    the last 24 hours, anomaly, operating hours of the aircraft so far and days since its last maintenance.

    ``readings`` carry ``anomaly_score`` and ``is_anomaly``. Every part is reduced to sensor and hour, or to aircraft and hour, before it meets
    the others, so the joins see hours, never readings.
    """
    keys = list(keys)
    hour = F.date_trunc("hour", F.col(ts)).alias("feature_timestamp")
    stats = windows.stat_features(readings, keys).drop("entropy")
    trends = windows.trend_direction(readings, keys)
    odd = readings.groupBy(*keys, hour).agg(F.max("anomaly_score").alias("anomaly_score"), F.bool_or("is_anomaly").alias("is_anomaly"))
    at = [*keys, "feature_timestamp"]
    table = windows.hourly_features(readings, keys).join(trends, at, "left").join(stats, at, "left").join(odd, at, "left")
    # One row for each aircraft and hour, so a window holds calendar slots.
    run = Window.partitionBy(by).orderBy("feature_timestamp").rowsBetween(Window.unboundedPreceding, 0)
    used = readings.select(by, hour).distinct().withColumn("operating_hours_cumulative", F.count(F.lit(1)).over(run).cast("double"))
    days = used.select(by, F.to_date("feature_timestamp").alias("day")).distinct()
    served = maintenance.select(by, F.to_date("start_ts").alias("day"), F.to_date("start_ts").alias("_last")).distinct()
    both = days.unionByName(served, allowMissingColumns=True).groupBy(by, "day").agg(F.max("_last").alias("_last"))
    upto = Window.partitionBy(by).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    since = both.select(by, "day", F.datediff("day", F.last("_last", ignorenulls=True).over(upto)).alias("days_since_last_maintenance"))
    context = used.withColumn("day", F.to_date("feature_timestamp")).join(since, [by, "day"], "left").drop("day")
    return table.join(context, [by, "feature_timestamp"], "left")


def aircraft_days(
    readings: DataFrame, maintenance: DataFrame, failures: DataFrame, fleet: DataFrame,
    thresholds=None, by="aircraft_id", high_risk=0.75,
) -> DataFrame:
    """Aircraft-day features: use, maintenance context, sensor health and failure history.

    ``readings`` carry ``anomaly_score`` and ``is_anomaly``. Readings are reduced
    to (aircraft, day, sensor type) and then to (aircraft, day) before any window.
    """
    over = F.lit(False)
    for _, kind, limit, _ in (thresholds or rules.THRESHOLD_RULES):
        over = over | ((F.col("sensor_type") == kind) & (F.col("measurement_value") >= limit))
    day = F.to_date("measurement_timestamp").alias("feature_date")
    per_type = readings.groupBy(by, day, "sensor_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("anomaly_score").alias("score"),
        F.max(F.col("is_anomaly").cast("int")).alias("odd"), F.max(over.cast("int")).alias("over"),
        F.max("anomaly_score").alias("top"),
    )
    days = per_type.groupBy(by, "feature_date").agg(
        F.sum("n").alias("flight_cycles_today"),
        (F.sum("n") * F.lit(1.0)).alias("flight_hours_today"),
        F.sum("odd").alias("sensors_with_anomalies_count"),
        (F.sum("score") / F.sum("n")).alias("avg_anomaly_score"),
        F.sum("over").alias("critical_sensors_count"),
        F.count_if(F.col("top") >= high_risk).alias("components_high_risk_count"),
        F.concat_ws(",", F.sort_array(F.collect_set(F.when(F.col("odd") == 1, F.col("sensor_type"))))).alias("_pattern"),
    )
    run_ = Window.partitionBy(by).orderBy("feature_date").rowsBetween(Window.unboundedPreceding, 0)
    days = days.select(
        "*", F.sum("flight_hours_today").over(run_).alias("cumulative_flight_hours"),
        F.sum("flight_cycles_today").over(run_).alias("cumulative_flight_cycles"),
        (1 - F.col("avg_anomaly_score")).alias("health_index"),
    )
    upkeep = maintenance.select(by, F.to_date("start_ts").alias("m_day"), "maintenance_type")
    seen = upkeep.select(by, F.col("m_day").alias("last_day")).distinct()
    planned = upkeep.where("maintenance_type = 'preventive'").select(by, F.col("m_day").alias("next_day")).distinct()
    broken = failures.select(by, F.to_date("failure_ts").alias("f_day"))
    days = joins.asof(days, seen, by, "feature_date", "last_day", ["last_day"], width=None)
    days = joins.asof(days, planned, by, "feature_date", "next_day", ["next_day"], forward=True, width=None)
    days = joins.trailing_counts(days, upkeep, by, "feature_date", "m_day",
                                 {"maintenance_events_last_30d": rules.MAINTENANCE_HISTORY_DAYS})
    days = joins.trailing_counts(days, broken, by, "feature_date", "f_day",
                                 {"failure_events_last_90d": rules.FAILURE_HISTORY_DAYS})
    today = broken.groupBy(by, F.col("f_day").alias("feature_date")).agg(F.count(F.lit(1)).alias("_failed"))
    days = days.join(today, [by, "feature_date"], "left").join(fleet.select(by, "model"), by, "left")
    # Read twice below; small beside the readings it comes from.
    return _similar_failures(staged(days)).select(
        by, "feature_date", "flight_hours_today", "flight_cycles_today", "cumulative_flight_hours", "cumulative_flight_cycles",
        F.datediff("feature_date", "last_day").alias("days_since_last_maintenance"),
        F.datediff("next_day", "feature_date").alias("days_until_next_scheduled_maintenance"),
        F.coalesce("maintenance_events_last_30d", F.lit(0)).alias("maintenance_events_last_30d"),
        F.coalesce("failure_events_last_90d", F.lit(0)).alias("failure_events_last_90d"),
        (F.coalesce("failure_events_last_90d", F.lit(0)) > 0).alias("failure_history_indicator"),
        "sensors_with_anomalies_count", "avg_anomaly_score", "critical_sensors_count", "components_high_risk_count",
        "health_index", "similar_failure_history_count",
    )


def _similar_failures(days: DataFrame) -> DataFrame:
    """Earlier failures of the same model on days with the same set of odd sensors.

    Counted per (model, pattern, day) first: a pattern shared by most of the fleet
    is one row per day, and the result returns by an equi-join.
    """
    key = ["model", "_pattern", "feature_date"]
    total = days.groupBy(*key).agg(F.sum(F.coalesce("_failed", F.lit(0))).alias("_f"))
    past = Window.partitionBy("model", "_pattern").orderBy("feature_date").rowsBetween(Window.unboundedPreceding, -1)
    total = total.select(*key, F.coalesce(F.sum("_f").over(past), F.lit(0)).alias("similar_failure_history_count"))
    total = total.withColumnsRenamed({k: f"_k_{k}" for k in key})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key]
    return days.join(total, same, "left").select(*days.columns, "similar_failure_history_count")


def latest_stock(snapshots: DataFrame, part="part_number", day="snapshot_date") -> DataFrame:
    """The newest snapshot of each part; one row per part survives the map side."""
    rest = [c for c in snapshots.columns if c != part]
    newest = snapshots.groupBy(part).agg(F.max_by(F.struct(*rest), F.col(day)).alias("_s"))
    return newest.select(part, "_s.*")


def availability(stock: DataFrame, kind="part_category", available="quantity_available") -> DataFrame:
    """Share of the parts of a kind with stock at their latest snapshot, and the flag from it."""
    share = F.avg((F.col(available) > 0).cast("double"))
    return stock.groupBy(kind).agg(share.alias("parts_available_share"), (share >= 0.5).alias("parts_available"))


def training_rows(days: DataFrame, failures: DataFrame, by="aircraft_id", day="feature_date",
                  stock: DataFrame | None = None, run_id: str | None = None) -> DataFrame:
    """One labelled row per aircraft-day with the features as JSON.

    ``stock`` adds per-entity part availability (:func:`availability` by entity) to them.
    """
    if stock is not None:
        days = days.join(stock, by, "left")
    fail_days = failures.select(by, F.to_date("failure_ts").alias("actual_failure_date")).distinct()
    hit = joins.asof(days, fail_days, by, day, "actual_failure_date", ["actual_failure_date"], forward=True, width=None)
    soon = F.datediff("actual_failure_date", day) <= rules.HORIZON_DAYS
    features = [c for c in days.columns if c not in (by, day)]
    return hit.select(
        by, F.col(day).alias("snapshot_date"), F.coalesce(soon, F.lit(False)).alias("failure_within_7_days"),
        F.when(soon, F.col("actual_failure_date")).alias("actual_failure_date"),
        F.to_json(F.struct(*features)).alias("features_json"), F.lit(run_id).alias("created_for_training_run_id"),
    )
