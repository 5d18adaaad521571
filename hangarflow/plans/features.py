"""Trend, anomaly, hourly, label and context features."""

from pyspark.sql import functions as F

from hangarflow import bindings as B, rules
from hangarflow.functions import scalars
from hangarflow.operators import gold, joins, labels, ordered, windows
from hangarflow.plans.basics import sql_rolling
from hangarflow.plans.registry import out, query
from hangarflow.plans.sql_views import S4

SIZES = rules.WINDOWS_DAYS


def sql_trend(cols=tuple(S4), sizes=tuple(SIZES)):
    items, made = [], []
    for c in cols:
        items.append(f"{c} - lag({c}) OVER (PARTITION BY aircraft_id ORDER BY date) AS {c}_diff_1d")
        made.append(f"{c}_diff_1d")
        for n in sizes:
            items.append(f"CASE WHEN count({c}) OVER w{n} >= 2 THEN ({c} - first_value({c}) OVER w{n}) / count(*) OVER w{n} END AS {c}_slope_{n}d")
            made.append(f"{c}_slope_{n}d")
    return ", ".join(items), made


def sql_anomaly(cols=tuple(S4)):
    items, made = [], []
    for c in cols:
        items.append(f"abs(({c} - avg({c}) OVER wa) / (stddev_samp({c}) OVER wa + 1e-6)) AS {c}_zscore")
        items.append(f"abs({c} - avg({c}) OVER wa) AS {c}_dist_from_mean")
        made += [f"{c}_zscore", f"{c}_dist_from_mean"]
    return ", ".join(items), made


_roll, _clause, _roll_names = sql_rolling()
_trend, _trend_names = sql_trend()
_anom, _anom_names = sql_anomaly()
_WA = "wa AS (PARTITION BY aircraft_id)"
_DOMAIN = "temperature * vibration AS temp_vibration_interaction, pressure / nullif(rpm + 1, 0) AS pressure_rpm_ratio"


@query("trend_features", out(f"SELECT *, {_trend} FROM daily WINDOW {_clause}",
                             dbl=" ".join(S4 + _trend_names), date="date", views="daily"))
def trend_features(spark, sf):
    return windows.trend(B.daily_wide(spark, sf), S4)


@query("anomaly_scores", out(f"SELECT *, {_anom} FROM daily WINDOW {_WA}",
                             dbl=" ".join(S4 + _anom_names), date="date", views="daily"))
def anomaly_scores(spark, sf):
    return windows.anomaly(B.daily_wide(spark, sf), S4)


@query("anomaly_expanding", out(
    "SELECT aircraft_id, date, " + ", ".join(
        f"abs({c} - avg({c}) OVER wp) / (stddev_samp({c}) OVER wp + 1e-6) AS {c}_zscore_past" for c in S4)
    + " FROM daily WINDOW wp AS (PARTITION BY aircraft_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
    dbl=" ".join(f"{c}_zscore_past" for c in S4), date="date", views="daily"))
def anomaly_expanding(spark, sf):
    return windows.anomaly_expanding(B.daily_wide(spark, sf), S4).drop(*S4)


@query("domain_features", out(f"""SELECT *, row_number() OVER (PARTITION BY aircraft_id ORDER BY date) - 1 AS days_in_operation, {_DOMAIN}
    FROM daily""", dbl=" ".join(S4) + " temp_vibration_interaction pressure_rpm_ratio", date="date", big="days_in_operation", views="daily"))
def domain_features(spark, sf):
    made = gold.domain(B.daily_wide(spark, sf))
    return made.withColumn("days_in_operation", F.col("days_in_operation").cast("long"))


@query("gold_daily", out(f"SELECT *, {_roll}, {_trend}, {_anom}, {_DOMAIN} FROM gold_silver WINDOW {_clause}, {_WA}",
                         dbl=" ".join(S4 + ["altitude", "ambient_temp", "flight_hours"] + _roll_names + _trend_names + _anom_names)
                         + " temp_vibration_interaction pressure_rpm_ratio", date="date", views="gold_silver"))
def gold_daily(spark, sf):
    """87 columns per aircraft-day: fill, cap, keep first, then every feature family."""
    return gold.gold_daily(B.daily_labeled(spark, sf), order=["cycle"])


# --------------------------------------------------------------------- hourly

_K = "aircraft_id, sensor_id, sensor_type"


def _win(h, name):
    return (f"{name} AS (PARTITION BY {_K} ORDER BY feature_timestamp RANGE BETWEEN INTERVAL {h - 1} HOUR PRECEDING AND CURRENT ROW)")


def _frame_stat(agg, h):
    return (f"(SELECT {agg} FROM readings r WHERE r.sensor_id = g.sensor_id AND r.measurement_timestamp >= g.feature_timestamp - INTERVAL {h - 1} HOUR "
            f"AND r.measurement_timestamp < g.feature_timestamp + INTERVAL 1 HOUR)")


_stats = ", ".join(
    f"{_frame_stat('avg(measurement_value)', h)} AS value_mean_{h}h, {_frame_stat('stddev_samp(measurement_value)', h)} AS value_std_{h}h, "
    f"{_frame_stat('min(measurement_value)', h)} AS value_min_{h}h, {_frame_stat('max(measurement_value)', h)} AS value_max_{h}h"
    for h in rules.HOURLY_WINDOWS)
_roc = ", ".join(
    f"value_current - last_value(value_current) OVER (PARTITION BY {_K} ORDER BY feature_timestamp RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL {h} HOUR PRECEDING) AS rate_of_change_{h}h"
    for h in (1, 6))


@query("hourly_features", out(f"""SELECT {_K}, feature_timestamp, value_current, {_stats}, {_roc} FROM hours g""",
    dbl="value_current rate_of_change_1h rate_of_change_6h " + " ".join(
        f"value_mean_{h}h value_std_{h}h value_min_{h}h value_max_{h}h" for h in rules.HOURLY_WINDOWS), ts="feature_timestamp", views="hours readings"))
def hourly_features(spark, sf):
    return windows.hourly_features(B.readings(spark, sf))


_trends = ", ".join(
    f"CASE WHEN (value_current - first_value(value_current) OVER t{h}) / nullif(abs(first_value(value_current) OVER t{h}), 0) > 0.01 THEN 'increasing' "
    f"WHEN (value_current - first_value(value_current) OVER t{h}) / nullif(abs(first_value(value_current) OVER t{h}), 0) < -0.01 THEN 'decreasing' ELSE 'stable' END AS trend_{h}h"
    for h in rules.TREND_WINDOWS)


@query("trend_direction", out(f"SELECT {_K}, feature_timestamp, {_trends} FROM hours WINDOW " + ", ".join(_win(h, f"t{h}") for h in rules.TREND_WINDOWS),
    ts="feature_timestamp", views="hours"))
def trend_direction(spark, sf):
    return windows.trend_direction(B.readings(spark, sf))


@query("regr_slope", out("SELECT " + _K + ", feature_timestamp, " + ", ".join(
    f"CASE WHEN count(*) OVER t{h} > 1 THEN regr_slope(mean, epoch(feature_timestamp) / 3600.0::DOUBLE - 473000) OVER t{h} END AS slope_{h}h" for h in rules.TREND_WINDOWS)
    + " FROM hours WINDOW " + ", ".join(_win(h, f"t{h}") for h in rules.TREND_WINDOWS),
    dbl=" ".join(f"slope_{h}h" for h in rules.TREND_WINDOWS), ts="feature_timestamp", views="hours"))
def regr_slope(spark, sf):
    return windows.regression_slope(B.readings(spark, sf))


@query("lag_features", out("SELECT g.aircraft_id, g.sensor_id, g.sensor_type, g.feature_timestamp, g.mean AS value, " + ", ".join(
    f"l{h}.mean AS value_lag_{h}h" for h in rules.LAG_HOURS) + " FROM hours g " + " ".join(
    f"LEFT JOIN hours l{h} ON l{h}.sensor_id = g.sensor_id AND l{h}.feature_timestamp = g.feature_timestamp - INTERVAL {h} HOUR" for h in rules.LAG_HOURS),
    dbl="value " + " ".join(f"value_lag_{h}h" for h in rules.LAG_HOURS), ts="feature_timestamp", views="hours"))
def lag_features(spark, sf):
    return windows.lag_features(B.readings(spark, sf))


_TYPE_HOURS = """SELECT DISTINCT sensor_type, date_trunc('hour', measurement_timestamp) AS feature_timestamp FROM readings"""


def _type_stat(agg):
    return (f"(SELECT {agg} FROM readings r WHERE r.sensor_type = g.sensor_type AND r.measurement_timestamp >= g.feature_timestamp - INTERVAL 23 HOUR "
            f"AND r.measurement_timestamp < g.feature_timestamp + INTERVAL 1 HOUR)")


@query("stat_features", out(f"""SELECT sensor_type, feature_timestamp,
    {_type_stat('CASE WHEN count(*) > 1 THEN stddev_samp(measurement_value) / avg(measurement_value) END')} AS coefficient_of_variation,
    {_type_stat('CASE WHEN count(*) > 2 THEN skewness(measurement_value) END')} AS skewness,
    {_type_stat('CASE WHEN count(*) > 3 THEN kurtosis(measurement_value) END')} AS kurtosis,
    (SELECT -sum(n / total * ln(n / total)) + 0.0 FROM (SELECT count(*)::DOUBLE AS n, (sum(count(*)) OVER ())::DOUBLE AS total FROM readings r
        WHERE r.sensor_type = g.sensor_type AND r.measurement_timestamp >= g.feature_timestamp - INTERVAL 23 HOUR
        AND r.measurement_timestamp < g.feature_timestamp + INTERVAL 1 HOUR GROUP BY coalesce(least(9, floor((measurement_value - g.lo) * 10 / nullif(g.hi - g.lo, 0))), 0))) AS entropy
    FROM (SELECT * FROM ({_TYPE_HOURS}) JOIN (SELECT sensor_type, min(measurement_value) AS lo, max(measurement_value) AS hi FROM readings GROUP BY 1) USING (sensor_type)) g""", dbl="coefficient_of_variation skewness kurtosis entropy", ts="feature_timestamp", views="readings"))
def stat_features(spark, sf):
    return windows.stat_features(B.readings(spark, sf), keys=("sensor_type",))


_SHAPE = ", ".join(_frame_stat(agg, 24) + f" AS {name}" for agg, name in (
    ("CASE WHEN count(*) > 1 THEN stddev_samp(measurement_value) / avg(measurement_value) END", "coefficient_of_variation"),
    ("CASE WHEN count(*) > 2 THEN skewness(measurement_value) END", "skewness"), ("CASE WHEN count(*) > 3 THEN kurtosis(measurement_value) END", "kurtosis")))


@query("stat_features_sensor", out(f"""SELECT {_K}, feature_timestamp, {_SHAPE} FROM hours g""", dbl="coefficient_of_variation skewness kurtosis", ts="feature_timestamp", views="hours readings"))
def stat_features_sensor(spark, sf):
    """At the grain of aircraft, sensor and hour."""
    return windows.stat_features(B.readings(spark, sf)).drop("entropy")


_of_hour = "FROM flagged r WHERE r.sensor_id = g.sensor_id AND date_trunc('hour', r.measurement_timestamp) = g.feature_timestamp"


@query("gold_hourly", out(f"""
    SELECT {_K}, feature_timestamp, value_current, {_stats}, {_roc}, {_trends}, {_SHAPE}, (SELECT max(anomaly_score) {_of_hour}) AS anomaly_score, (SELECT bool_or(is_anomaly) {_of_hour}) AS is_anomaly,
        (SELECT count(DISTINCT date_trunc('hour', measurement_timestamp)) FROM readings r WHERE r.aircraft_id = g.aircraft_id AND r.measurement_timestamp < g.feature_timestamp + INTERVAL 1 HOUR)::DOUBLE AS operating_hours_cumulative,
        date_diff('day', (SELECT max(start_ts::DATE) FROM maintenance m WHERE m.aircraft_id = g.aircraft_id AND m.start_ts::DATE <= g.feature_timestamp::DATE), g.feature_timestamp::DATE)::INTEGER AS days_since_last_maintenance
    FROM hours g WINDOW {", ".join(_win(h, f"t{h}") for h in rules.TREND_WINDOWS)}""",
    dbl="value_current rate_of_change_1h rate_of_change_6h coefficient_of_variation skewness kurtosis anomaly_score operating_hours_cumulative " + " ".join(
        f"value_mean_{h}h value_std_{h}h value_min_{h}h value_max_{h}h" for h in rules.HOURLY_WINDOWS), ts="feature_timestamp", views="hours readings flagged maintenance"))
def gold_hourly(spark, sf):
    """The whole feature table of sensors and hours."""
    return gold.sensor_hours(_flagged(spark, sf), B.maintenance(spark, sf))


# ---------------------------------------------------------- series and labels

@query("utilisation", out("""
    SELECT aircraft_id, date, sum(flight_hours) OVER w AS cumulative_hours, count(*) OVER w AS cumulative_cycles,
        CASE WHEN spell > 0 THEN row_number() OVER (PARTITION BY aircraft_id, spell ORDER BY date) - 1 END AS cycles_since_maintenance,
        sum(flight_hours) OVER (PARTITION BY aircraft_id ORDER BY date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW) / 30 AS utilisation_rate
    FROM (SELECT *, sum(maintained) OVER (PARTITION BY aircraft_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spell
        FROM (SELECT aircraft_id, measurement_timestamp::DATE AS date, count(*)::DOUBLE AS flight_hours,
            max(CASE WHEN sensor_type = 'rpm' THEN 1 ELSE 0 END) AS maintained FROM readings GROUP BY ALL))
    WINDOW w AS (PARTITION BY aircraft_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    dbl="cumulative_hours utilisation_rate", date="date", views="readings"))
def utilisation(spark, sf):
    daily = B.readings(spark, sf).groupBy("aircraft_id", F.to_date("measurement_timestamp").alias("date")).agg(
        F.count(F.lit(1)).cast("double").alias("flight_hours"),
        F.max((F.col("sensor_type") == "rpm").cast("int")).alias("maintained"))
    return windows.utilisation(daily)


@query("minmax_norm", out("""
    SELECT engine_id, cycle, (measurement_value - min(measurement_value) OVER w) / nullif(max(measurement_value) OVER w - min(measurement_value) OVER w, 0) AS measurement_value_norm
    FROM engines WINDOW w AS (PARTITION BY engine_id)""", dbl="measurement_value_norm", views="engines"))
def minmax_norm(spark, sf):
    return windows.minmax(B.engines(spark, sf), ["measurement_value"]).select("engine_id", "cycle", "measurement_value_norm")


@query("autocorr", out("""
    SELECT aircraft_id, corr(x, l1) AS autocorr_1, corr(x, l7) AS autocorr_7 FROM (
        SELECT aircraft_id, x, lag(x, 1) OVER w AS l1, lag(x, 7) OVER w AS l7
        FROM (SELECT aircraft_id, measurement_timestamp::DATE AS date, avg(measurement_value) AS x FROM readings GROUP BY ALL)
        WINDOW w AS (PARTITION BY aircraft_id ORDER BY date)) GROUP BY 1""", dbl="autocorr_1 autocorr_7", views="readings"))
def autocorr(spark, sf):
    daily = B.readings(spark, sf).groupBy("aircraft_id", F.to_date("measurement_timestamp").alias("date")).agg(
        F.avg("measurement_value").alias("x"))
    return windows.autocorrelation(daily, "aircraft_id", "date", "x", [1, 7])


@query("seasonality", out("""
    SELECT sensor_type, hour(measurement_timestamp)::INTEGER AS hour_of_day, count(*) AS readings,
        avg(measurement_value) - (SELECT avg(measurement_value) FROM readings o WHERE o.sensor_type = r.sensor_type) AS seasonal_effect
    FROM readings r GROUP BY 1, 2""", dbl="seasonal_effect", views="readings"))
def seasonality(spark, sf):
    return windows.seasonality(B.readings(spark, sf))


def _flagged(spark, sf):
    return gold.anomaly_flag(B.readings(spark, sf), "measurement_value", "sensor_type")


@query("anomaly_flag", out("SELECT id, sensor_type, anomaly_score, is_anomaly FROM flagged", dbl="anomaly_score", views="flagged"))
def anomaly_flag(spark, sf):
    return _flagged(spark, sf).select("id", "sensor_type", "anomaly_score", "is_anomaly")


@query("rul_label", out("""
    SELECT engine_id, cycle, rul AS "RUL", CASE WHEN rul <= 30 THEN 1 ELSE 0 END AS will_fail_30_cycles, CASE WHEN rul = 0 THEN 1 ELSE 0 END AS failed
    FROM (SELECT *, max(cycle) OVER (PARTITION BY engine_id) - cycle AS rul FROM engines)""", views="engines"))
def rul_label(spark, sf):
    return labels.within(labels.rul(B.engines(spark, sf).select("engine_id", "cycle")))


@query("failure_label", out("""
    SELECT r.id, r.aircraft_id, CASE WHEN min(f.failure_ts) IS NULL THEN 0 ELSE 1 END AS failure_within_7_days
    FROM readings r LEFT JOIN failures f ON f.aircraft_id = r.aircraft_id AND f.failure_ts >= r.measurement_timestamp
        AND f.failure_ts <= r.measurement_timestamp + INTERVAL 7 DAY GROUP BY 1, 2""", views="readings failures"))
def failure_label(spark, sf):
    r = B.readings(spark, sf).select("id", "aircraft_id", "measurement_timestamp")
    return labels.failure_within(r, B.failures(spark, sf)).select("id", "aircraft_id", "failure_within_7_days")


@query("failure_band", out("""
    SELECT aircraft_id, date, cycle, failure_cycle, coalesce(cycle BETWEEN failure_cycle - 7 AND failure_cycle, false) AS in_warning_band
    FROM (SELECT *, min(CASE WHEN failed = 1 THEN cycle END) OVER (PARTITION BY aircraft_id) AS failure_cycle FROM labeled)""",
    date="date", views="labeled"))
def failure_band(spark, sf):
    return labels.failure_band(B.daily_labeled(spark, sf)).select("aircraft_id", "date", "cycle", "failure_cycle", "in_warning_band")


@query("asof_since", out("""
    SELECT r.id, r.aircraft_id, m.start_ts AS last_maintenance, date_diff('day', m.start_ts::DATE, r.measurement_timestamp::DATE)::INTEGER AS days_since_last_maintenance
    FROM readings r ASOF LEFT JOIN maintenance m ON m.aircraft_id = r.aircraft_id AND r.measurement_timestamp >= m.start_ts""",
    ts="last_maintenance", views="readings maintenance"))
def asof_since(spark, sf):
    r = B.readings(spark, sf).select("id", "aircraft_id", "measurement_timestamp")
    m = B.maintenance(spark, sf).select("aircraft_id", "start_ts")
    hit = joins.asof(r, m, "aircraft_id", "measurement_timestamp", "start_ts", ["start_ts"])
    return hit.select("id", "aircraft_id", F.col("start_ts").alias("last_maintenance"),
                      scalars.days_between(F.col("measurement_timestamp"), F.col("start_ts")).alias("days_since_last_maintenance"))


@query("asof_until", out("""
    SELECT r.id, r.aircraft_id, m.start_ts AS next_scheduled, date_diff('day', r.measurement_timestamp::DATE, m.start_ts::DATE)::INTEGER AS days_until_next_scheduled
    FROM readings r ASOF LEFT JOIN (SELECT * FROM maintenance WHERE maintenance_type = 'preventive') m
        ON m.aircraft_id = r.aircraft_id AND r.measurement_timestamp <= m.start_ts""",
    ts="next_scheduled", views="readings maintenance"))
def asof_until(spark, sf):
    r = B.readings(spark, sf).select("id", "aircraft_id", "measurement_timestamp")
    m = B.maintenance(spark, sf).where("maintenance_type = 'preventive'").select("aircraft_id", "start_ts")
    hit = joins.asof(r, m, "aircraft_id", "measurement_timestamp", "start_ts", ["start_ts"], forward=True)
    return hit.select("id", "aircraft_id", F.col("start_ts").alias("next_scheduled"),
                      scalars.days_between(F.col("start_ts"), F.col("measurement_timestamp")).alias("days_until_next_scheduled"))


def _count_sql(src, ts, n):
    return f"(SELECT count(*) FROM {src} e WHERE e.aircraft_id = d.aircraft_id AND e.{ts}::DATE BETWEEN d.date - {n} AND d.date)"


@query("interval_counts", out(f"""
    SELECT aircraft_id, date, {_count_sql('maintenance', 'start_ts', 7)} AS maintenance_events_last_7d,
        {_count_sql('maintenance', 'start_ts', 30)} AS maintenance_events_last_30d,
        {_count_sql('failures', 'failure_ts', 90)} AS failure_events_last_90d,
        {_count_sql('failures', 'failure_ts', 90)} > 0 AS failure_history_indicator FROM daily d""",
    date="date", views="daily maintenance failures"))
def interval_counts(spark, sf):
    days = B.daily_wide(spark, sf).select("aircraft_id", "date")
    m = B.maintenance(spark, sf).select("aircraft_id", F.to_date("start_ts").alias("d"))
    f = B.failures(spark, sf).select("aircraft_id", F.to_date("failure_ts").alias("d"))
    got = joins.trailing_counts(days, m, "aircraft_id", "date", "d", {
        "maintenance_events_last_7d": 7, "maintenance_events_last_30d": rules.MAINTENANCE_HISTORY_DAYS})
    got = joins.trailing_counts(got, f, "aircraft_id", "date", "d", {"failure_events_last_90d": rules.FAILURE_HISTORY_DAYS})
    return got.withColumn("failure_history_indicator", F.col("failure_events_last_90d") > 0)


def _aircraft_days(spark, sf):
    return gold.aircraft_days(_flagged(spark, sf), B.maintenance(spark, sf), B.failures(spark, sf), B.fleet(spark, sf))


@query("aircraft_features", out("SELECT * FROM acdays", dbl="flight_hours_today cumulative_flight_hours avg_anomaly_score health_index",
                                date="feature_date", views="acdays"))
def aircraft_features(spark, sf):
    return _aircraft_days(spark, sf)


@query("training_set", out("""
    SELECT aircraft_id, feature_date AS snapshot_date, gap IS NOT NULL AND gap <= 7 AS failure_within_7_days,
        CASE WHEN gap <= 7 THEN feature_date + gap::INTEGER END AS actual_failure_date,
        flight_cycles_today AS json_cycles, maintenance_events_last_30d AS json_events, parts_available AS json_parts
    FROM (SELECT *, date_diff('day', feature_date, (SELECT min(failure_ts::DATE) FROM failures f WHERE f.aircraft_id = a.aircraft_id
            AND f.failure_ts::DATE >= a.feature_date)) AS gap FROM acdays a)
    LEFT JOIN (SELECT aircraft_id, parts_available FROM fleet JOIN (SELECT part_category, CASE WHEN avg((quantity_available > 0)::INTEGER) >= 0.5 THEN 'true' ELSE 'false' END AS parts_available
        FROM latest_stock GROUP BY 1) ON part_category = CASE model WHEN 'AUTOMOBILE' THEN 'ECONOMY' WHEN 'BUILDING' THEN 'LARGE'
            WHEN 'FURNITURE' THEN 'MEDIUM' WHEN 'HOUSEHOLD' THEN 'SMALL' WHEN 'MACHINERY' THEN 'STANDARD' END) USING (aircraft_id)""",
    date="snapshot_date actual_failure_date", views="acdays failures fleet latest_stock"))
def training_set(spark, sf):
    """Labelled rows; three features are read back from the JSON to show its content."""
    by_kind = gold.availability(gold.latest_stock(B.inventory(spark, sf)))
    f = B.fleet(spark, sf).select("aircraft_id", B.part_kind(F.col("model")).alias("part_category"))
    stock = f.join(by_kind, "part_category").drop("part_category")
    rows = gold.training_rows(_aircraft_days(spark, sf), B.failures(spark, sf), stock=stock)
    field = F.col("features_json")
    return rows.select(
        "aircraft_id", "snapshot_date", "failure_within_7_days", "actual_failure_date",
        scalars.json_number(field, "$.flight_cycles_today").alias("json_cycles"),
        scalars.json_number(field, "$.maintenance_events_last_30d").alias("json_events"),
        F.get_json_object(field, "$.parts_available").alias("json_parts"))
