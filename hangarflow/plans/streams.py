"""Streaming queries, run to the end of the given events and returned as tables."""

from pyspark.sql import functions as F

from hangarflow import bindings as B
from hangarflow.plans.registry import out, query
from hangarflow.session import work_dir
from hangarflow.streaming import streams


def _readings(spark, sf):
    schema = B.table(spark, sf, "events").schema
    e = streams.read(spark, sf, schema, "events.parquet")
    kind = B.sensor_type(F.col("event_type"))
    # Watermarks need a timestamp with zone.
    return e.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("aircraft_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), kind).alias("sensor_id"), kind.alias("sensor_type"),
        F.col("ts").cast("timestamp").alias("measurement_timestamp"), F.col("value").alias("measurement_value"))


_AGG = "count(*) AS readings, avg(measurement_value) AS mean, stddev_samp(measurement_value) AS std, min(measurement_value) AS min, max(measurement_value) AS max"


@query("stream_tumbling", out(f"""
    SELECT sensor_type, date_trunc('hour', measurement_timestamp)::TIMESTAMP AS window_start, date_trunc('hour', measurement_timestamp)::TIMESTAMP + INTERVAL 1 HOUR AS window_end, {_AGG}
    FROM readings GROUP BY 1, 2, 3""", dbl="mean std min max", ts="window_start window_end", views="readings"))
def stream_tumbling(spark, sf):
    return streams.drain_closed(lambda r: streams.windowed(r, "1 hour"), _readings(spark, sf))


@query("stream_sliding", out(f"""
    SELECT sensor_type, s AS window_start, s + INTERVAL 3 HOUR AS window_end, {_AGG}
    FROM (SELECT *, date_trunc('hour', measurement_timestamp)::TIMESTAMP - INTERVAL 1 HOUR * back AS s FROM readings, range(3) r(back)) GROUP BY 1, 2, 3""",
    dbl="mean std min max", ts="window_start window_end", views="readings"))
def stream_sliding(spark, sf):
    return streams.drain_closed(lambda r: streams.windowed(r, "3 hours", "1 hour"), _readings(spark, sf))


@query("stream_session", out("""
    SELECT aircraft_id, min(measurement_timestamp) AS session_start, max(measurement_timestamp) + INTERVAL 6 HOUR AS session_end, count(*) AS readings
    FROM (SELECT *, sum(opens) OVER (PARTITION BY aircraft_id ORDER BY measurement_timestamp) AS no FROM (SELECT *,
        CASE WHEN measurement_timestamp - lag(measurement_timestamp) OVER (PARTITION BY aircraft_id ORDER BY measurement_timestamp) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM readings))
    GROUP BY aircraft_id, no""", ts="session_start session_end", views="readings"))
def stream_session(spark, sf):
    return streams.drain_closed(streams.sessions, _readings(spark, sf))


@query("stream_bronze", out("""
    SELECT measurement_timestamp::DATE AS day, sensor_type, count(*) AS readings, sum(measurement_value) AS total FROM readings GROUP BY 1, 2""",
    dbl="total", date="day", views="readings"))
def stream_bronze(spark, sf):
    table = streams.drain_append(streams.bronze(_readings(spark, sf)), by=["day"])
    return table.groupBy("day", "sensor_type").agg(F.count(F.lit(1)).alias("readings"), F.sum("measurement_value").alias("total"))


@query("stream_dedup", out("SELECT id, sensor_id, measurement_timestamp FROM readings", ts="measurement_timestamp", views="readings"))
def stream_dedup(spark, sf):
    """Every reading arrives twice and is kept once."""
    r = _readings(spark, sf)
    once = streams.dedup(r.unionByName(_readings(spark, sf)), ["aircraft_id", "sensor_id", "measurement_timestamp"])
    return streams.drain_append(once).select("id", "sensor_id", "measurement_timestamp")


@query("stream_alerts", out("""
    SELECT a.aircraft_id, a.alert_timestamp, a.rule, a.severity, a.observed, f.model, f.location FROM alerts_t a LEFT JOIN fleet f ON f.aircraft_id = a.aircraft_id""",
    dbl="observed", ts="alert_timestamp", views="alerts_t fleet"))
def stream_alerts(spark, sf):
    fleet = B.fleet(spark, sf).select("aircraft_id", "model", "location")
    got = streams.drain_append(streams.alerts(_readings(spark, sf), fleet))
    return got.select("aircraft_id", "alert_timestamp", "rule", "severity", "observed", "model", "location")


@query("stream_state", out("""
    SELECT sensor_id, 'seen' AS event, max(measurement_timestamp) AS seen_at, arg_max(measurement_value, measurement_timestamp) AS last_value,
        count(*) FILTER (WHERE measurement_timestamp > coalesce(last_ok, TIMESTAMP '1970-01-01'))::INTEGER AS streak, count(*) FILTER (WHERE measurement_value >= 50) AS breaches
    FROM (SELECT *, max(CASE WHEN measurement_value < 50 THEN measurement_timestamp END) OVER (PARTITION BY sensor_id) AS last_ok FROM readings) GROUP BY 1""",
    dbl="last_value", ts="seen_at", views="readings"))
def stream_state(spark, sf):
    """Last value and streak per sensor after all events ."""
    with streams.rocks(spark):
        return streams.drain_append(streams.sensor_state(_readings(spark, sf), limit=50.0)).where("event = 'seen'")


@query("stream_upsert", out("""
    SELECT sensor_id, sensor_type, arg_max(measurement_value, measurement_timestamp) AS measurement_value, max(measurement_timestamp) AS measurement_timestamp, arg_max(id, measurement_timestamp) AS id
    FROM readings GROUP BY 1, 2""", dbl="measurement_value", ts="measurement_timestamp", views="readings"))
def stream_upsert(spark, sf):
    r = _readings(spark, sf).select("sensor_id", "sensor_type", "measurement_value", "measurement_timestamp", "id")
    path = work_dir(spark)
    spark.createDataFrame([], r.schema).write.partitionBy("sensor_type").parquet(path)
    streams.upsert_each(r, path, ["sensor_type", "sensor_id"], ["measurement_timestamp", "id"], by=["sensor_type"])
    return spark.read.schema(r.schema).parquet(path)
