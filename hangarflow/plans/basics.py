"""First slice: load checks, top entities, series, ranks, rolling features."""

from pyspark.sql import Window, functions as F

from hangarflow import bindings as B, rules
from hangarflow.operators import windows
from hangarflow.plans.registry import out, query
from hangarflow.plans.sql_views import S4


def sql_rolling(cols=tuple(S4), sizes=tuple(rules.WINDOWS_DAYS), by="aircraft_id", ts="date"):
    """(select items, window clause) of the rolling set; also the list of names."""
    items, made = [], []
    for c in cols:
        for n in sizes:
            for f, g in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
                items.append(f"{g}({c}) OVER w{n} AS {c}_rolling_{f}_{n}d")
                made.append(f"{c}_rolling_{f}_{n}d")
    clause = ", ".join(
        f"w{n} AS (PARTITION BY {by} ORDER BY {ts} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in sizes)
    return ", ".join(items), clause, made


_items, _clause, _names = sql_rolling()


@query("rolling_features", out(
    f"SELECT *, {_items} FROM daily WINDOW {_clause}", dbl=" ".join(S4 + _names), date="date", views="daily"))
def rolling_features(spark, sf):
    return windows.rolling(B.daily_wide(spark, sf), rules.SENSORS)


@query("load_verify", out("""
    SELECT count(*) AS total_records, count(DISTINCT aircraft_id) AS unique_aircraft,
        min(measurement_timestamp)::DATE AS earliest_date, max(measurement_timestamp)::DATE AS latest_date,
        count(*) FILTER (WHERE sensor_type = 'error' AND measurement_value >= 100) AS failure_labels
    FROM readings""", date="earliest_date latest_date", views="readings"))
def load_verify(spark, sf):
    r = B.readings(spark, sf)
    t = F.to_date("measurement_timestamp")
    return r.agg(
        F.count(F.lit(1)).alias("total_records"), F.count_distinct("aircraft_id").alias("unique_aircraft"),
        F.min(t).alias("earliest_date"), F.max(t).alias("latest_date"),
        F.count_if((F.col("sensor_type") == "error") & (F.col("measurement_value") >= B.FAILURE_VALUE)).alias("failure_labels"),
    )


@query("entity_topk", out("""
    SELECT aircraft_id, count(*) AS total_readings, round(avg(temperature) + 1e-9, 2) AS avg_temperature,
        round(avg(vibration) + 1e-9, 4) AS avg_vibration, round(avg(pressure) + 1e-9, 2) AS avg_pressure,
        sum(will_fail_7days)::BIGINT AS days_in_warning_window
    FROM labeled GROUP BY 1 ORDER BY days_in_warning_window DESC, aircraft_id LIMIT 10""",
    dbl="avg_temperature avg_vibration avg_pressure", views="labeled"))
def entity_topk(spark, sf):
    d = B.daily_labeled(spark, sf)
    eps = 1e-9
    return d.groupBy("aircraft_id").agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.round(F.avg("temperature") + eps, 2).alias("avg_temperature"),
        F.round(F.avg("vibration") + eps, 4).alias("avg_vibration"),
        F.round(F.avg("pressure") + eps, 2).alias("avg_pressure"),
        F.sum("will_fail_7days").alias("days_in_warning_window"),
    ).orderBy(F.desc("days_in_warning_window"), "aircraft_id").limit(10)


@query("entity_series", out("""
    SELECT date, cycle, temperature, vibration, will_fail_7days, failed FROM labeled
    WHERE aircraft_id = (SELECT aircraft_id FROM labeled GROUP BY 1 ORDER BY sum(failed) DESC, 1 LIMIT 1)
    ORDER BY date""", dbl="temperature vibration", date="date", views="labeled"))
def entity_series(spark, sf):
    """The series of one aircraft: the one with the most failure days in the fleet."""
    d = B.daily_labeled(spark, sf)
    worst = (
        d.groupBy("aircraft_id").agg(F.sum("failed").alias("n"))
        .agg(F.max_by("aircraft_id", F.struct("n", -F.col("aircraft_id"))).alias("aircraft_id")).scalar()
    )
    return d.where(F.col("aircraft_id") == worst).select(
        "date", "cycle", "temperature", "vibration", "will_fail_7days", "failed").orderBy("date")


@query("rolling_rank", out("""
    SELECT aircraft_id, date, value, avg(value) OVER (PARTITION BY aircraft_id ORDER BY date
            ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS value_7day_avg,
        rank() OVER (PARTITION BY aircraft_id ORDER BY value DESC) AS value_rank
    FROM (SELECT aircraft_id, measurement_timestamp::DATE AS date, max(measurement_value) AS value
        FROM readings WHERE sensor_type IN ('temperature', 'vibration') GROUP BY 1, 2)""",
    dbl="value value_7day_avg", date="date", views="readings"))
def rolling_rank(spark, sf):
    daily = (
        B.readings(spark, sf).where(F.col("sensor_type").isin("temperature", "vibration"))
        .groupBy("aircraft_id", F.to_date("measurement_timestamp").alias("date"))
        .agg(F.max("measurement_value").alias("value"))
    )
    w = Window.partitionBy("aircraft_id")
    return daily.select(
        "aircraft_id", "date", "value",
        F.avg("value").over(w.orderBy("date").rowsBetween(-6, 0)).alias("value_7day_avg"),
        F.rank().over(w.orderBy(F.desc("value"))).cast("long").alias("value_rank"),
    )
