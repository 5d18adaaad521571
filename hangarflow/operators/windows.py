"""Window features.

Daily functions expect one row per entity and day, so an entity's window holds
at most its calendar days. Hourly functions work on the hourly grid built by
:func:`hourly_grid`, where each sensor has at most one row per hour whatever its
reading rate; readings reach it through partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from hangarflow import rules
from hangarflow.functions.scalars import divide
from hangarflow.operators.ordered import names, per_entity, spread


def _over(by, ts=None, n: int | None = None) -> str:
    """OVER clause: whole entity, ordered, or the last ``n`` rows."""
    text = "PARTITION BY " + ", ".join(names(by))
    if ts:
        text += f" ORDER BY {ts}"
    if n:
        text += f" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"
    return f"OVER ({text})"


def rolling_columns(cols, sizes, by, ts) -> list[Column]:
    stats = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    return [
        F.expr(f"{fn}({c}) {_over(by, ts, n)} AS {c}_rolling_{name}_{n}d")
        for c in cols for n in sizes for name, fn in stats.items()
    ]


def rolling(df, cols, sizes=tuple(rules.WINDOWS_DAYS), by="aircraft_id", ts="date") -> DataFrame:
    """Rolling mean, sample std, min and max over the last n rows (at least one)."""
    return spread(df, by).select("*", *rolling_columns(cols, sizes, by, ts))


def trend_columns(cols, sizes, by, ts) -> list[Column]:
    made = []
    for c in cols:
        made.append(F.expr(f"{c} - lag({c}, 1) {_over(by, ts)} AS {c}_diff_1d"))
        for n in sizes:
            w = _over(by, ts, n)
            made.append(F.expr(
                f"CASE WHEN count({c}) {w} >= 2 THEN ({c} - first({c}) {w}) / count(1) {w} END AS {c}_slope_{n}d"))
    return made


def trend(df, cols, sizes=tuple(rules.WINDOWS_DAYS), by="aircraft_id", ts="date") -> DataFrame:
    """One-step difference and (last - first) / rows over the window."""
    return spread(df, by).select("*", *trend_columns(cols, sizes, by, ts))


def anomaly_columns(cols, by) -> list[Column]:
    w = _over(by)
    made = []
    for c in cols:
        off = f"abs({c} - avg({c}) {w})"
        made += [F.expr(f"{off} / (stddev_samp({c}) {w} + 1e-6D) AS {c}_zscore"), F.expr(f"{off} AS {c}_dist_from_mean")]
    return made


def anomaly(df, cols, by="aircraft_id") -> DataFrame:
    """Distance from the entity's whole-history mean, plain and in deviations."""
    return df.select("*", *anomaly_columns(cols, by))


def anomaly_expanding(df, cols, by="aircraft_id", ts="date") -> DataFrame:
    """The same against past rows only, for training without look-ahead."""
    w = Window.partitionBy(*names(by)).orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    made = []
    for c in cols:
        off = F.abs(F.col(c) - F.avg(c).over(w))
        made.append((off / (F.stddev_samp(c).over(w) + 1e-6)).alias(f"{c}_zscore_past"))
    return df.select("*", *made)


def domain_columns(columns: Sequence[str], by, ts) -> list[Column]:
    made = []
    if "cycle" not in columns:
        w = Window.partitionBy(*names(by)).orderBy(ts)
        made.append((F.row_number().over(w) - 1).alias("days_in_operation"))
    if {"temperature", "vibration"} <= set(columns):
        made.append((F.col("temperature") * F.col("vibration")).alias("temp_vibration_interaction"))
    if {"pressure", "rpm"} <= set(columns):
        made.append(divide(F.col("pressure"), F.col("rpm") + 1).alias("pressure_rpm_ratio"))
    return made


def minmax(df, cols, by="engine_id") -> DataFrame:
    """Per-entity min-max scaling; a constant series gives null."""
    stats = {}
    for c in cols:
        stats |= {f"_lo_{c}": F.min(c), f"_hi_{c}": F.max(c)}
    joined = per_entity(df, by, stats)
    return joined.select(*df.columns, *[
        divide(F.col(c) - F.col(f"_lo_{c}"), F.col(f"_hi_{c}") - F.col(f"_lo_{c}")).alias(f"{c}_norm") for c in cols
    ])


# ---------------------------------------------------------------- hourly grid

def hourly_grid(readings: DataFrame, keys=("aircraft_id", "sensor_id", "sensor_type"),
                ts="measurement_timestamp", value="measurement_value") -> DataFrame:
    """Per sensor and hour: count, last value (of two at one time the greater) and central moments, all mergeable."""
    ok = F.col(value).isNotNull()
    return (
        readings.where(ok)
        .groupBy(*keys, F.floor(F.unix_seconds(ts) / 3600).cast("long").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"),
            (F.var_pop(value) * F.count(value)).alias("m2"),
            F.min(value).alias("low"), F.max(value).alias("high"),
            F.max_by(value, F.struct(ts, value)).alias("value_current"),
        )
    )


def _over_hours(keys, hours: int):
    return Window.partitionBy(*keys).orderBy("hour").rangeBetween(-(hours - 1), 0)


def merged_mean(w) -> Column:
    return F.sum(F.col("n") * F.col("mean")).over(w) / F.sum("n").over(w)


def shifted(grid: DataFrame, keys) -> DataFrame:
    """Power sums about a per-sensor centre, which keeps the merge stable."""
    centre = F.first("mean").over(Window.partitionBy(*keys).orderBy("hour"))
    d = F.col("mean") - centre
    return grid.withColumn("d", d).select(
        "*", (F.col("n") * F.col("d")).alias("s1"), (F.col("m2") + F.col("n") * F.col("d") * F.col("d")).alias("s2")
    )


def merged_std(w) -> Column:
    n, s1, s2 = F.sum("n").over(w), F.sum("s1").over(w), F.sum("s2").over(w)
    return F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), (s2 - s1 * s1 / n)) / (n - 1)))


def hourly_features(readings: DataFrame, keys=("aircraft_id", "sensor_id", "sensor_type")) -> DataFrame:
    """Rolling statistics and rates of change per sensor-hour over time frames."""
    grid = shifted(hourly_grid(readings, keys), keys)
    past = Window.partitionBy(*keys).orderBy("hour")
    cols = [F.col("value_current")]
    for h in rules.HOURLY_WINDOWS:
        w = _over_hours(keys, h)
        cols += [merged_mean(w).alias(f"value_mean_{h}h"), merged_std(w).alias(f"value_std_{h}h"),
                 F.min("low").over(w).alias(f"value_min_{h}h"), F.max("high").over(w).alias(f"value_max_{h}h")]
    for h in (1, 6):
        before = F.last("value_current").over(past.rangeBetween(Window.unboundedPreceding, -h))
        cols.append((F.col("value_current") - before).alias(f"rate_of_change_{h}h"))
    return grid.select(*keys, F.timestamp_seconds(F.col("hour") * 3600).alias("feature_timestamp"), *cols)


def trend_direction(readings, keys=("aircraft_id", "sensor_id", "sensor_type")) -> DataFrame:
    """increasing / decreasing / stable from the relative change over the window."""
    grid = hourly_grid(readings, keys)
    cols = []
    for h in rules.TREND_WINDOWS:
        first = F.first("value_current").over(_over_hours(keys, h))
        change = divide(F.col("value_current") - first, F.abs(first))
        cols.append(
            F.when(change > rules.TREND_BAND, "increasing").when(change < -rules.TREND_BAND, "decreasing")
            .otherwise("stable").alias(f"trend_{h}h")
        )
    return grid.select(*keys, F.timestamp_seconds(F.col("hour") * 3600).alias("feature_timestamp"), *cols)


def regression_slope(readings, keys=("aircraft_id", "sensor_id", "sensor_type")) -> DataFrame:
    """Least-squares slope of the hourly mean, per hour, over each window."""
    grid = hourly_grid(readings, keys)
    cols = [
        F.regr_slope(F.col("mean"), F.col("hour").cast("double")).over(_over_hours(keys, h)).alias(f"slope_{h}h")
        for h in rules.TREND_WINDOWS
    ]
    return grid.select(*keys, F.timestamp_seconds(F.col("hour") * 3600).alias("feature_timestamp"), *cols)


def lag_features(readings, keys=("aircraft_id", "sensor_id", "sensor_type")) -> DataFrame:
    """Hourly mean h hours earlier; null when that hour has no reading."""
    grid = hourly_grid(readings, keys)
    past = Window.partitionBy(*keys).orderBy("hour")
    cols = [F.last("mean").over(past.rangeBetween(-h, -h)).alias(f"value_lag_{h}h") for h in rules.LAG_HOURS]
    return grid.select(*keys, F.timestamp_seconds(F.col("hour") * 3600).alias("feature_timestamp"),
                       F.col("mean").alias("value"), *cols)


def stat_features(readings, keys=("aircraft_id", "sensor_id", "sensor_type"), ts="measurement_timestamp",
                  value="measurement_value", kind="sensor_type", bins: int = 10) -> DataFrame:
    """Coefficient of variation, bias-corrected skewness and kurtosis, and entropy in 24 h.

    Hours carry central moments; they are moved to one centre per sensor (the
    first hour's mean) and added over the frame, so 24 hourly rows give the
    moments of all their readings. Entropy uses ``bins`` equal bins between the least and the
    greatest value of the sensor's ``kind``, so any unit or range is resolved alike.
    """
    ok = per_entity(readings.where(F.col(value).isNotNull()), kind, {"_lo": F.min(value), "_hi": F.max(value)})
    place = F.floor(F.try_divide((F.col(value) - F.col("_lo")) * bins, F.col("_hi") - F.col("_lo"))).cast("int")
    bin_no = F.least(F.lit(bins - 1), F.coalesce(place, F.lit(0)))
    var = F.var_pop(value)
    hours = ok.groupBy(*keys, F.floor(F.unix_seconds(ts) / 3600).cast("long").alias("hour")).agg(
        F.count(value).cast("double").alias("n"), F.avg(value).alias("mean"), var.alias("v"),
        F.coalesce(F.skewness(value), F.lit(0.0)).alias("g1"), F.coalesce(F.kurtosis(value), F.lit(-3.0)).alias("g2"),
        *[F.count_if(bin_no == b).alias(f"b{b}") for b in range(bins)],
    )
    centre = F.first("mean").over(Window.partitionBy(*keys).orderBy("hour"))
    n, d = F.col("n"), F.col("d")
    m2, m3 = n * F.col("v"), F.col("g1") * n * F.pow("v", F.lit(1.5))
    m4 = (F.col("g2") + 3) * n * F.col("v") * F.col("v")
    moved = hours.withColumn("centre", centre).withColumn("d", F.col("mean") - F.col("centre")).select(
        *keys, "hour", "centre", "n", *[f"b{b}" for b in range(bins)],
        (n * d).alias("s1"), (m2 + n * d * d).alias("s2"), (m3 + 3 * d * m2 + n * d * d * d).alias("s3"),
        (m4 + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d).alias("s4"),
    )
    w = _over_hours(keys, 24)
    sums = moved.select(
        *keys, "hour", "centre", F.sum("n").over(w).alias("n"),
        *[F.sum(f"s{i}").over(w).alias(f"s{i}") for i in range(1, 5)],
        F.array(*[F.sum(f"b{b}").over(w) for b in range(bins)]).alias("counts"),
    )
    m = F.col("s1") / n
    c2 = F.greatest(F.lit(0.0), F.col("s2") / n - m * m)
    c3 = F.col("s3") / n - 3 * m * F.col("s2") / n + 2 * m * m * m
    c4 = F.col("s4") / n - 4 * m * F.col("s3") / n + 6 * m * m * F.col("s2") / n - 3 * m * m * m * m
    spread = c2 > 1e-9
    g1, g2 = c3 / F.pow(c2, F.lit(1.5)), c4 / (c2 * c2) - 3
    entropy = F.aggregate(
        "counts", F.lit(0.0),
        lambda acc, c: acc - F.when(c > 0, (c / F.col("n")) * F.log(c / F.col("n"))).otherwise(0.0),
    )
    return sums.select(
        *keys, F.timestamp_seconds(F.col("hour") * 3600).alias("feature_timestamp"),
        F.when(n > 1, divide(F.sqrt(c2 * n / (n - 1)), F.col("centre") + m)).alias("coefficient_of_variation"),
        F.when((n >= 3) & spread, g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias("skewness"),
        F.when((n >= 4) & spread, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)).alias("kurtosis"),
        entropy.alias("entropy"),
    )


def autocorrelation(grid: DataFrame, by, ts, value: str, lags: Sequence[int]) -> DataFrame:
    """corr(x_t, x_{t-k}) per entity, k in rows of a bounded (daily or hourly) grid."""
    w = Window.partitionBy(*names(by)).orderBy(ts)
    lagged = grid.select(*names(by), value, *[F.lag(value, k).over(w).alias(f"_l{k}") for k in lags])
    return lagged.groupBy(*names(by)).agg(*[F.corr(value, f"_l{k}").alias(f"autocorr_{k}") for k in lags])


def seasonality(readings, by=("sensor_type",), ts="measurement_timestamp", value="measurement_value") -> DataFrame:
    """Hour-of-day mean minus overall mean, from one pass of hour-level sums."""
    per_hour = readings.groupBy(*by, F.hour(ts).alias("hour_of_day")).agg(
        F.count(value).alias("readings"), F.sum(value).alias("_sum"))
    w = Window.partitionBy(*by)  # at most 24 rows
    overall = F.sum("_sum").over(w) / F.sum("readings").over(w)
    return per_hour.select(*by, "hour_of_day", "readings",
                           (F.col("_sum") / F.col("readings") - overall).alias("seasonal_effect"))


def utilisation(daily: DataFrame, by="aircraft_id", day="date", hours="flight_hours",
                reset="maintained") -> DataFrame:
    """Running hours and cycles, cycles since the last maintenance day, 30-day rate."""
    order = Window.partitionBy(by).orderBy(day)
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    month = Window.partitionBy(by).orderBy(F.unix_date(day).cast("long")).rangeBetween(-29, 0)
    grouped = daily.withColumn("_spell", F.sum(reset).over(run))
    spell = Window.partitionBy(by, "_spell").orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return grouped.select(
        by, day,
        F.sum(hours).over(run).alias("cumulative_hours"),
        F.count(F.lit(1)).over(run).alias("cumulative_cycles"),
        F.when(F.col("_spell") > 0, F.count(F.lit(1)).over(spell) - 1).alias("cycles_since_maintenance"),
        (F.sum(hours).over(month) / 30).alias("utilisation_rate"),
    )


def monotone(df, by, ts, value, width=None, order=()) -> DataFrame:
    """Per entity: number of steps and of decreases in time order."""
    from hangarflow.operators.ordered import previous

    steps = previous(df.where(F.col(value).isNotNull()), by, ts, {"_before": value}, order, width)
    return steps.groupBy(*names(by)).agg(
        F.count("_before").alias("steps"), F.count_if(F.col(value) < F.col("_before")).alias("decreases")
    )
