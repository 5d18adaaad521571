"""Quality checks, type conformance, cleaning and the silver tables."""

from pyspark.sql import functions as F

from hangarflow import bindings as B, rules
from hangarflow.functions import scalars
from hangarflow.operators import cleaning, joins, ordered, quality
from hangarflow.plans.registry import out, query
from hangarflow.plans.sql_views import S4

DAILY_COLS = ["aircraft_id", "date", *S4]
_in_range = {s: f"{s} BETWEEN {lo} AND {hi}" for s, (lo, hi) in B.TEST_RANGES.items()}
_validity = (
    "(" + " + ".join(f"count(*) FILTER (WHERE {c})" for c in _in_range.values()) + ")::DOUBLE / ("
    + " + ".join(f"count({s})" for s in S4) + ")"
)
_nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in DAILY_COLS)
_completeness = f"1 - ({_nulls})::DOUBLE / (count(*) * {len(DAILY_COLS)})"
_timeliness = f"greatest(0.0, 1 - date_diff('day', max(date), DATE '{B.AS_OF}') / 365.0::DOUBLE)"


@query("dq_completeness", out(f"SELECT {_completeness} AS completeness FROM daily", dbl="completeness", views="daily"))
def dq_completeness(spark, sf):
    return quality.completeness(B.daily_wide(spark, sf))


@query("dq_validity", out(f"SELECT {_validity} AS validity FROM daily", dbl="validity", views="daily"))
def dq_validity(spark, sf):
    return quality.validity(B.daily_wide(spark, sf), B.TEST_RANGES)


@query("dq_consistency", out("""
    SELECT coalesce(avg(CASE WHEN decreases = 0 THEN 1.0::DOUBLE ELSE 0.0 END), 1.0) AS consistency,
        count(*) AS entities_checked, sum(decreases)::BIGINT AS decreases
    FROM (SELECT sensor_id, count(before) AS steps, count(*) FILTER (WHERE measurement_value < before) AS decreases
        FROM (SELECT *, lag(measurement_value) OVER (PARTITION BY sensor_id ORDER BY measurement_timestamp, id) AS before
            FROM readings) GROUP BY 1) WHERE steps > 0""", dbl="consistency", views="readings"))
def dq_consistency(spark, sf):
    r = B.readings(spark, sf)
    return quality.consistency(r, "sensor_id", "measurement_timestamp", "measurement_value",
                               width=ordered.DAY, order=["id"])


@query("dq_timeliness", out(f"SELECT {_timeliness} AS timeliness FROM daily", dbl="timeliness", views="daily"))
def dq_timeliness(spark, sf):
    return quality.timeliness(B.daily_wide(spark, sf), "date", B.AS_OF)


_miss = " ".join(
    f"UNION ALL SELECT 'missing_{c}', count(*) FILTER (WHERE {c} IS NULL)::DOUBLE FROM daily" for c in DAILY_COLS)


@query("dq_report", out(f"""
    SELECT 'completeness' AS metric, {_completeness} AS value FROM daily
    UNION ALL SELECT 'validity', {_validity} FROM daily
    UNION ALL SELECT 'timeliness', {_timeliness} FROM daily
    UNION ALL SELECT 'overall_score', (({_completeness}) + ({_validity}) + ({_timeliness})) / 3 FROM daily
    UNION ALL SELECT 'record_count', count(*)::DOUBLE FROM daily
    UNION ALL SELECT 'column_count', 6.0 {_miss}""", dbl="value", views="daily"))
def dq_report(spark, sf):
    return quality.report(B.daily_wide(spark, sf), B.TEST_RANGES, "date", B.AS_OF,
                          ("completeness", "validity", "timeliness"))


@query("null_profile", out(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
    f"100.0::DOUBLE * count(*) FILTER (WHERE {c} IS NULL) / count(*) AS missing_pct FROM daily" for c in DAILY_COLS),
    dbl="missing_pct", views="daily"))
def null_profile(spark, sf):
    return quality.null_profile(B.daily_wide(spark, sf))


@query("dup_rate", out("""
    SELECT count(*) AS total_records, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_records,
        (count(*) - count(DISTINCT (l_orderkey, l_linenumber)))::DOUBLE / count(*) AS duplicate_rate
    FROM lineitem""", dbl="duplicate_rate"))
def dup_rate(spark, sf):
    return quality.duplicates(B.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_num = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("low_variance", out(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(stddev_samp({c}), 4) AS std, stddev_samp({c}) < 0.001 AS near_constant FROM lineitem"
    for c in _num), dbl="std"))
def low_variance(spark, sf):
    got = quality.low_variance(B.table(spark, sf, "lineitem"), _num)
    return got.withColumn("std", F.round("std", 4))


# ------------------------------------------------------------------ rule rows

CHECK_TIME = f"{B.AS_OF} 00:00:00"
_LAST = "TIMESTAMP '2024-02-01 00:00:00'"


def _rule_sql(name, kind, scope, issue, threshold, severity, src):
    return (
        f"SELECT '{name}' AS check_name, '{kind}' AS check_type, count(*) FILTER (WHERE {scope}) AS total_records, "
        f"count(*) FILTER (WHERE ({scope}) AND ({issue})) AS records_with_issues, {threshold}::DOUBLE AS threshold_value, "
        f"'{severity}' AS severity FROM {src}")


_RULES = [
    _rule_sql("required_fields_present", "completeness", "true",
              "aircraft_id IS NULL OR sensor_id IS NULL OR measurement_timestamp IS NULL OR measurement_value IS NULL",
              1.0, "critical", "gappy"),
    _rule_sql("non_null_values", "completeness", "true", "measurement_value IS NULL", 0.95, "warning", "gappy"),
    _rule_sql("temperature_range", "validity", "sensor_type = 'temperature' AND measurement_value IS NOT NULL",
              "measurement_value NOT BETWEEN -50 AND 200", 1.0, "warning", "gappy"),
    _rule_sql("vibration_range", "validity", "sensor_type = 'vibration' AND measurement_value IS NOT NULL",
              "measurement_value NOT BETWEEN 0 AND 100", 1.0, "warning", "gappy"),
    _rule_sql("pressure_range", "validity", "sensor_type = 'pressure' AND measurement_value IS NOT NULL",
              "measurement_value NOT BETWEEN 0 AND 1000", 1.0, "warning", "gappy"),
    _rule_sql("timestamp_in_range", "validity", "true",
              f"measurement_timestamp < TIMESTAMP '2020-01-01' OR measurement_timestamp > {_LAST}",
              1.0, "critical", "gappy"),
    """SELECT 'no_duplicate_records' AS check_name, 'consistency' AS check_type, sum(n)::BIGINT AS total_records,
        sum(n - 1)::BIGINT AS records_with_issues, 0.99::DOUBLE AS threshold_value, 'warning' AS severity
        FROM (SELECT count(*) AS n FROM gappy GROUP BY aircraft_id, sensor_id, measurement_timestamp)""",
    """SELECT 'timestamp_order' AS check_name, 'consistency' AS check_type, count(*) AS total_records,
        count(*) FILTER (WHERE measurement_timestamp < before) AS records_with_issues, 1.0::DOUBLE, 'warning'
        FROM (SELECT measurement_timestamp, lag(measurement_timestamp) OVER (PARTITION BY sensor_id ORDER BY id) AS before FROM gappy)""",
    f"""SELECT 'data_freshness' AS check_name, 'timeliness' AS check_type, count(*) AS total_records,
        CASE WHEN max(measurement_timestamp) < TIMESTAMP '{CHECK_TIME}' - INTERVAL 48 HOUR THEN count(*) ELSE 0 END,
        1.0::DOUBLE, 'critical' FROM gappy""",
    _rule_sql("date_logic", "validity", "true", "to_hours(labor_hours) < to_hours(0)", 1.0, "critical", "maintenance"),
    _rule_sql("labor_hours_positive", "validity", "labor_hours IS NOT NULL",
              "labor_hours NOT BETWEEN 0 AND 200", 1.0, "warning", "maintenance"),
]
_NAMES = ("required_fields_present non_null_values temperature_range vibration_range pressure_range "
          "timestamp_in_range no_duplicate_records timestamp_order data_freshness").split()


@query("dq_rules", out("""
    SELECT CASE WHEN check_name IN ('date_logic', 'labor_hours_positive') THEN 'maintenance_records' ELSE 'sensor_data' END AS table_name,
        TIMESTAMP '%s' AS check_timestamp, check_name, check_type, total_records, records_with_issues, quality_score,
        threshold_value, CASE WHEN quality_score >= threshold_value THEN 'pass' WHEN severity = 'critical' THEN 'fail' ELSE 'warning' END AS status,
        quality_score < threshold_value AND severity = 'critical' AS alert_sent
    FROM (SELECT *, coalesce(1 - records_with_issues::DOUBLE / nullif(total_records, 0), 1.0) AS quality_score
        FROM (%s))""" % (CHECK_TIME, " UNION ALL ".join(_RULES)),
    dbl="quality_score threshold_value", ts="check_timestamp", views="gappy maintenance"))
def dq_rules(spark, sf):
    """Row rules in one pass per table; key, order and freshness rules as small aggregates."""
    r = B.gappy_readings(spark, sf)
    v, t = F.col("measurement_value"), F.col("measurement_timestamp")
    missing = F.col("aircraft_id").isNull() | F.col("sensor_id").isNull() | t.isNull() | v.isNull()
    checks = [
        quality.rule("required_fields_present", "completeness", missing, 1.0, "critical"),
        quality.rule("non_null_values", "completeness", v.isNull(), 0.95, "warning"),
    ]
    for kind, (lo, hi) in rules.READING_RANGES.items():
        checks.append(quality.rule(f"{kind}_range", "validity", ~v.between(lo, hi), 1.0, "warning",
                                   (F.col("sensor_type") == kind) & v.isNotNull()))
    late = F.date_add(F.lit(B.AS_OF).cast("date"), 1).cast("timestamp")
    checks.append(quality.rule("timestamp_in_range", "validity",
                               (t < F.lit(rules.TIMESTAMP_FLOOR).cast("timestamp")) | (t > late), 1.0, "critical"))
    sensor = quality.check_rules(r, "sensor_data", checks, CHECK_TIME)

    def extra(frame, name, kind, threshold, severity):
        row = frame.select(
            F.lit(name).alias("check_name"), F.lit(kind).alias("check_type"), "total_records", "records_with_issues",
            F.lit(threshold).alias("threshold_value"), F.lit(severity).alias("severity"),
            F.coalesce(1 - scalars.divide(F.col("records_with_issues"), F.col("total_records")), F.lit(1.0)).alias("quality_score"))
        return quality.finish_rules(row, "sensor_data", CHECK_TIME)

    dups = quality.duplicates(r, ["aircraft_id", "sensor_id", "measurement_timestamp"]).select(
        "total_records", F.col("duplicate_records").alias("records_with_issues"))
    order = ordered.previous(r, "sensor_id", "id", {"_before": "measurement_timestamp"}, width=100_000).agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(t < F.col("_before")).alias("records_with_issues"))
    fresh = r.agg(F.count(F.lit(1)).alias("total_records"), F.max(t).alias("newest"))
    stale = F.col("newest") < F.lit(CHECK_TIME).cast("timestamp") - F.expr(f"INTERVAL {rules.FRESHNESS_HOURS} HOURS")
    fresh = fresh.select("total_records", F.when(stale, F.col("total_records")).otherwise(0).alias("records_with_issues"))
    m = B.maintenance(spark, sf)
    end = F.col("start_ts") + F.make_dt_interval(hours=F.col("labor_hours"))
    upkeep = quality.check_rules(m, "maintenance_records", [
        quality.rule("date_logic", "validity", end < F.col("start_ts"), 1.0, "critical"),
        quality.rule("labor_hours_positive", "validity", ~F.col("labor_hours").between(*rules.LABOR_HOURS_RANGE), 1.0,
                     "warning", F.col("labor_hours").isNotNull()),
    ], CHECK_TIME)
    return (
        sensor.unionByName(extra(dups, "no_duplicate_records", "consistency", 1 - rules.DUPLICATE_RATE_MAX, "warning"))
        .unionByName(extra(order, "timestamp_order", "consistency", 1.0, "warning"))
        .unionByName(extra(fresh, "data_freshness", "timeliness", 1.0, "critical"))
        .unionByName(upkeep)
    )


@query("dq_alerts", out("""
    SELECT 'high_error_rate' AS alert, 'high' AS severity, error_rate AS observed, 0.10::DOUBLE AS limit_value, error_rate > 0.10 AS raised
    FROM (SELECT count(*) FILTER (WHERE id %% 89 = 0 OR id %% 97 = 0)::DOUBLE / count(*) AS error_rate FROM readings)
    UNION ALL
    SELECT 'data_freshness_breach', 'critical', age, 48.0, age > 48
    FROM (SELECT date_diff('microsecond', max(measurement_timestamp), TIMESTAMP '%s') / 3.6e9 AS age FROM readings)""" % CHECK_TIME,
    dbl="observed limit_value", views="readings"))
def dq_alerts(spark, sf):
    """Alerts on the load itself: error rate and age of the newest reading."""
    rate = quality.error_rate(_conformed(spark, sf), rules.ERROR_RATE_PIPELINE).select(F.col("error_rate").alias("observed"))
    age = B.readings(spark, sf).agg(
        scalars.hours_between(F.max("measurement_timestamp"), F.lit(CHECK_TIME).cast("timestamp")).alias("observed"))

    def alert(frame, name, severity, limit):
        return frame.select(F.lit(name).alias("alert"), F.lit(severity).alias("severity"), "observed",
                            F.lit(float(limit)).alias("limit_value"), (F.col("observed") > limit).alias("raised"))

    return alert(rate, "high_error_rate", "high", rules.ERROR_RATE_ALERT).unionByName(
        alert(age, "data_freshness_breach", "critical", rules.FRESHNESS_HOURS))


@query("dq_accuracy", out("""
    SELECT count(*) AS failures, count(*) FILTER (WHERE explained) AS explained_failures,
        count(*) FILTER (WHERE explained)::DOUBLE / count(*) AS accuracy
    FROM (SELECT f.id, EXISTS (SELECT 1 FROM readings r WHERE r.aircraft_id = f.aircraft_id
            AND r.measurement_timestamp <= f.failure_ts AND r.measurement_timestamp >= f.failure_ts - INTERVAL 7 DAY
            AND ((r.sensor_type = 'temperature' AND r.measurement_value NOT BETWEEN 5 AND 150)
              OR (r.sensor_type = 'vibration' AND r.measurement_value NOT BETWEEN 1 AND 80)
              OR (r.sensor_type = 'pressure' AND r.measurement_value NOT BETWEEN 0 AND 100)
              OR (r.sensor_type = 'rpm' AND r.measurement_value NOT BETWEEN 10 AND 200))) AS explained
        FROM failures f)""", dbl="accuracy", views="readings failures"))
def dq_accuracy(spark, sf):
    """Share of failures preceded within 7 days by a reading outside its band."""
    odd = F.lit(False)
    for kind, (lo, hi) in B.TEST_RANGES.items():
        odd = odd | ((F.col("sensor_type") == kind) & ~F.col("measurement_value").between(lo, hi))
    warnings = B.readings(spark, sf).where(odd).select("aircraft_id", "id", F.col("measurement_timestamp").alias("warning_ts"))
    seen = joins.asof(B.failures(spark, sf), warnings, "aircraft_id", "failure_ts", "warning_ts", ["warning_ts"], ties=["id"])
    near = F.unix_micros("failure_ts") - F.unix_micros("warning_ts") <= 7 * ordered.DAY * 1_000_000
    return seen.agg(
        F.count(F.lit(1)).alias("failures"), F.count_if(near).alias("explained_failures"),
        scalars.divide(F.count_if(near), F.count(F.lit(1))).alias("accuracy"))


# ------------------------------------------------------ schema and conformance

_RAW_TYPES = {"measurement_timestamp": "timestamp", "measurement_value": "double", "aircraft_id": "bigint"}
_PARSED = """CASE WHEN id % 97 = 0 THEN NULL ELSE coalesce(try_strptime(measurement_timestamp, '%Y-%m-%d %H:%M:%S'),
    try_strptime(measurement_timestamp, '%Y-%m-%dT%H:%M:%S'), try_strptime(measurement_timestamp, '%Y-%m-%d %H:%M:%S.%f')) END"""


def _conformed(spark, sf):
    raw = B.raw_text(spark, sf)
    quality.require_columns(raw, ["aircraft_id", "sensor_id", "sensor_type", "measurement_timestamp", "measurement_value"], strict=True)
    return quality.conform(raw, _RAW_TYPES, {"measurement_timestamp": scalars.parse_time(F.col("measurement_timestamp"))})


@query("schema_conform", out(f"""
    SELECT id, aircraft_id::BIGINT AS aircraft_id, sensor_type, {_PARSED} AS measurement_timestamp,
        try_cast(measurement_value AS DOUBLE) AS measurement_value,
        concat_ws(',', CASE WHEN id % 97 = 0 THEN 'measurement_timestamp' END, CASE WHEN id % 89 = 0 THEN 'measurement_value' END) AS errors
    FROM raw_text""", dbl="measurement_value", ts="measurement_timestamp", views="raw_text"))
def schema_conform(spark, sf):
    c = _conformed(spark, sf)
    return c.select("id", "aircraft_id", "sensor_type", "measurement_timestamp", "measurement_value",
                    F.concat_ws(",", "_errors").alias("errors"))


_EXPECTED = {"event_id": "bigint", "ts": "timestamp", "user_id": "string", "event_type": "string",
             "value": "double", "unit": "string"}


@query("schema_drift", out("""
    SELECT * FROM (
        SELECT 'event_id' AS column_name, 'bigint' AS expected_type, 'bigint' AS actual_type, 'same' AS change, count(event_id) AS filled_rows FROM events
        UNION ALL SELECT 'ts', 'timestamp', 'timestamp_ntz', 'retyped', count(ts) FROM events
        UNION ALL SELECT 'user_id', 'string', 'bigint', 'retyped', count(user_id) FROM events
        UNION ALL SELECT 'event_type', 'string', 'string', 'same', count(event_type) FROM events
        UNION ALL SELECT 'value', 'double', 'double', 'same', count(value) FROM events
        UNION ALL SELECT 'unit', 'string', NULL, 'removed', 0 FROM events LIMIT 6)
    UNION ALL SELECT 'props', NULL, 'string', 'added', count(props) FROM events"""))
def schema_drift(spark, sf):
    return quality.schema_drift(B.table(spark, sf, "events"), _EXPECTED)


@query("quarantine", out("""
    SELECT id, measurement_timestamp AS raw_time, measurement_value AS raw_value,
        concat_ws(',', CASE WHEN id % 97 = 0 THEN 'measurement_timestamp' END, CASE WHEN id % 89 = 0 THEN 'measurement_value' END) AS errors
    FROM raw_text WHERE id % 97 = 0 OR id % 89 = 0""", views="raw_text"))
def quarantine(spark, sf):
    """Rows set aside, as they came in, with the columns that did not fit."""
    raw = B.raw_text(spark, sf)
    kept = raw.select("*", F.col("measurement_timestamp").alias("raw_time"), F.col("measurement_value").alias("raw_value"))
    conformed = quality.conform(kept, _RAW_TYPES, {"measurement_timestamp": scalars.parse_time(F.col("measurement_timestamp"))})
    _, bad, _ = quality.apply_policy(conformed, "quarantine")
    return bad.select("id", "raw_time", "raw_value", F.concat_ws(",", "_errors").alias("errors"))


@query("error_gate", out("""
    SELECT count(*) AS records, count(*) FILTER (WHERE id % 97 = 0 OR id % 89 = 0) AS errors,
        count(*) FILTER (WHERE id % 97 = 0 OR id % 89 = 0)::DOUBLE / count(*) AS error_rate,
        count(*) FILTER (WHERE id % 97 = 0 OR id % 89 = 0)::DOUBLE / count(*) <= 0.05 AS within_limit
    FROM raw_text""", dbl="error_rate", views="raw_text"))
def error_gate(spark, sf):
    return quality.error_rate(_conformed(spark, sf), rules.ERROR_RATE_PIPELINE)


# ------------------------------------------------------------------- cleaning

def _ffill_sql(c, part="aircraft_id", order="date"):
    return (f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({c} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))")


@query("impute_ffill", out(
    f"SELECT aircraft_id, date, {', '.join(f'{_ffill_sql(c)} AS {c}' for c in S4)} FROM daily",
    dbl=" ".join(S4), date="date", views="daily"))
def impute_ffill(spark, sf):
    return cleaning.impute(B.daily_wide(spark, sf), S4, "forward_fill")


@query("impute_ffill_readings", out(
    f"SELECT id, sensor_id, {_ffill_sql('measurement_value', 'sensor_id', 'measurement_timestamp, id')} AS measurement_value FROM gappy",
    dbl="measurement_value", views="gappy"))
def impute_ffill_readings(spark, sf):
    """Fill at reading grain: chunked by day, so one busy sensor does not become one task."""
    r = B.gappy_readings(spark, sf)
    return cleaning.impute(r, ["measurement_value"], "forward_fill", "sensor_id", "measurement_timestamp", ["id"],
                           width=ordered.DAY).select("id", "sensor_id", "measurement_value")


def _interp_sql(c):
    w = "PARTITION BY aircraft_id ORDER BY date"
    pre = f"OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    post = f"OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    at = f"CASE WHEN {c} IS NOT NULL THEN pos END"
    pv, pp = f"last_value({c} IGNORE NULLS) {pre}", f"last_value({at} IGNORE NULLS) {pre}"
    nv, np_ = f"first_value({c} IGNORE NULLS) {post}", f"first_value({at} IGNORE NULLS) {post}"
    return (f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {np_} IS NULL THEN {pv} WHEN {pp} IS NULL THEN NULL "
            f"ELSE {pv} + ({nv} - {pv}) * (pos - {pp})::DOUBLE / ({np_} - {pp}) END")


@query("impute_interp", out(
    f"SELECT aircraft_id, date, {', '.join(f'{_interp_sql(c)} AS {c}' for c in S4)} FROM "
    "(SELECT *, row_number() OVER (PARTITION BY aircraft_id ORDER BY date) AS pos FROM daily)",
    dbl=" ".join(S4), date="date", views="daily"))
def impute_interp(spark, sf):
    return cleaning.impute(B.daily_wide(spark, sf), S4, "interpolate")


@query("impute_mean", out(
    f"SELECT aircraft_id, date, {', '.join(f'coalesce({c}, (SELECT avg({c}) FROM daily)) AS {c}' for c in S4)} FROM daily",
    dbl=" ".join(S4), date="date", views="daily"))
def impute_mean(spark, sf):
    return cleaning.impute(B.daily_wide(spark, sf), S4, "mean")


@query("impute_drop", out(
    "SELECT * FROM daily WHERE temperature IS NOT NULL AND vibration IS NOT NULL", dbl=" ".join(S4), date="date", views="daily"))
def impute_drop(spark, sf):
    return cleaning.impute(B.daily_wide(spark, sf), ["temperature", "vibration"], "drop")


@query("impute_context", out("""
    SELECT id, sensor_id, CASE WHEN v IS NOT NULL THEN v WHEN short THEN last_v ELSE med END AS measurement_value,
        v IS NULL AND (short OR med IS NOT NULL) AS is_imputed,
        CASE WHEN v IS NOT NULL THEN NULL WHEN short THEN 'forward_fill' WHEN med IS NOT NULL THEN 'median' END AS imputation_method
    FROM (SELECT g.id, g.sensor_id, g.v, g.last_v, coalesce(g.t - g.last_t <= INTERVAL 60 MINUTE AND g.nulls - g.last_nulls <= 5, false) AS short,
            (SELECT median(r.measurement_value) FROM gappy r WHERE r.sensor_id = g.sensor_id
                AND r.measurement_timestamp >= g.t - INTERVAL 24 HOUR AND r.measurement_timestamp < g.t) AS med
        FROM (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER w AS last_t,
                last_value(v IGNORE NULLS) OVER w AS last_v,
                last_value(CASE WHEN v IS NOT NULL THEN nulls END IGNORE NULLS) OVER w AS last_nulls
            FROM (SELECT id, sensor_id, measurement_timestamp AS t, measurement_value AS v,
                    sum(CASE WHEN measurement_value IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY sensor_id ORDER BY measurement_timestamp, id) AS nulls
                FROM gappy)
            WINDOW w AS (PARTITION BY sensor_id ORDER BY t, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) g)""",
    dbl="measurement_value", views="gappy"))
def impute_context(spark, sf):
    filled = cleaning.impute_context(B.gappy_readings(spark, sf), width=ordered.DAY)
    return filled.select("id", "sensor_id", "measurement_value", "is_imputed", "imputation_method")


def _iqr(c, p):
    return f"quantile_cont({c}, {p})"


_bounds_iqr = ", ".join(
    f"{_iqr(c, .25)} - 3 * ({_iqr(c, .75)} - {_iqr(c, .25)}) AS lo_{c}, {_iqr(c, .75)} + 3 * ({_iqr(c, .75)} - {_iqr(c, .25)}) AS hi_{c}" for c in S4)
_capped = ", ".join(
    f"CASE WHEN {c} IS NOT NULL THEN greatest(lo_{c}, least(hi_{c}, {c})) END AS {c}" for c in S4)


@query("outlier_iqr", out(
    f"SELECT aircraft_id, date, {_capped} FROM daily, (SELECT {_bounds_iqr} FROM daily)", dbl=" ".join(S4), date="date", views="daily"))
def outlier_iqr(spark, sf):
    return cleaning.outliers(B.daily_wide(spark, sf), S4, "iqr", 3.0, "cap")


_bounds_z = ", ".join(
    f"avg({c}) - 3 * stddev_samp({c}) AS lo_{c}, avg({c}) + 3 * stddev_samp({c}) AS hi_{c}" for c in S4)


@query("outlier_zscore", out(
    f"SELECT aircraft_id, date, {_capped} FROM daily, (SELECT {_bounds_z} FROM daily)", dbl=" ".join(S4), date="date", views="daily"))
def outlier_zscore(spark, sf):
    return cleaning.outliers(B.daily_wide(spark, sf), S4, "zscore", 3.0, "cap")


@query("outlier_remove", out(
    "SELECT aircraft_id, date, temperature, vibration, pressure, rpm FROM daily, "
    f"(SELECT {_bounds_z} FROM daily) WHERE " + " AND ".join(
        f"({c} IS NULL OR {c} BETWEEN lo_{c} AND hi_{c})" for c in S4), dbl=" ".join(S4), date="date", views="daily"))
def outlier_remove(spark, sf):
    return cleaning.outliers(B.daily_wide(spark, sf), S4, "zscore", 3.0, "remove")


_SCORE = """greatest(q1 - measurement_value, measurement_value - q3, 0.0) / (q3 - q1)"""
_FLAG = f"""({_SCORE} > 3.0 OR (sensor_type = 'temperature' AND measurement_value NOT BETWEEN -50 AND 200)
    OR (sensor_type = 'vibration' AND measurement_value NOT BETWEEN 0 AND 100)
    OR (sensor_type = 'pressure' AND measurement_value NOT BETWEEN 0 AND 1000))"""


@query("outlier_flag", out(f"""
    SELECT id, sensor_type, measurement_value, {_SCORE} AS outlier_score, {_FLAG} AS is_outlier
    FROM readings JOIN (SELECT sensor_type, quantile_cont(measurement_value, 0.25) AS q1, quantile_cont(measurement_value, 0.75) AS q3
        FROM readings GROUP BY 1) USING (sensor_type)""", dbl="measurement_value outlier_score", views="readings"))
def outlier_flag(spark, sf):
    r = B.readings(spark, sf).select("id", "sensor_type", "measurement_value")
    return cleaning.outlier_score(r, "measurement_value", "sensor_type", domain=rules.READING_RANGES)


_LINE = ("l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax "
         "l_returnflag l_linestatus l_shipdate").split()


@query("dedup_first", out("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey,
        l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
    dbl="l_quantity l_extendedprice", ts="l_shipdate"))
def dedup_first(spark, sf):
    line = B.table(spark, sf, "lineitem")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
    return cleaning.keep_first(line, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")


@query("cleaning_log", out("""
    SELECT 'handle_missing_values' AS operation, 'drop' AS detail, sum(CASE WHEN temperature IS NULL THEN 1 ELSE 0 END
            + CASE WHEN vibration IS NULL THEN 1 ELSE 0 END)::BIGINT AS before_count, 0::BIGINT AS after_count FROM daily
    UNION ALL SELECT 'remove_outliers', 'cap', count(*), count(*) FROM daily WHERE temperature IS NOT NULL AND vibration IS NOT NULL
    UNION ALL SELECT 'deduplicate', 'first', count(*), count(DISTINCT (aircraft_id, date)) FROM daily
        WHERE temperature IS NOT NULL AND vibration IS NOT NULL""", views="daily"))
def cleaning_log(spark, sf):
    """What each cleaning step changed, as rows; counted in the data, not on the driver."""
    cols = ["temperature", "vibration"]
    raw = B.daily_wide(spark, sf)
    kept = cleaning.impute(raw, cols, "drop")
    capped = cleaning.outliers(kept, cols)
    deduped = cleaning.keep_first(capped, ["aircraft_id", "date"], [*cols, "pressure", "rpm"])

    def empties(df):
        return F.coalesce(F.sum(F.col(cols[0]).isNull().cast("long") + F.col(cols[1]).isNull().cast("long")), F.lit(0))

    def entry(op, detail, before, after):
        return before.select(F.lit(op).alias("operation"), F.lit(detail).alias("detail"), F.col("n").alias("before_count"), after.scalar().alias("after_count"))

    n = F.count(F.lit(1)).alias("n")
    return (
        entry("handle_missing_values", "drop", raw.agg(empties(raw).alias("n")), kept.agg(empties(kept).alias("n")))
        .unionByName(entry("remove_outliers", "cap", kept.agg(n), capped.agg(n)))
        .unionByName(entry("deduplicate", "first", capped.agg(n), deduped.agg(n)))
    )


# ---------------------------------------------------- scalar standardisation

_CONV = """CASE sensor_type WHEN 'temperature' THEN CASE measurement_unit WHEN 'fahrenheit' THEN (v - 32) * 5 / 9 WHEN 'kelvin' THEN v - 273.15::DOUBLE ELSE v END
    WHEN 'pressure' THEN CASE measurement_unit WHEN 'psi' THEN v * 0.0689476::DOUBLE WHEN 'pascal' THEN v / 100000 ELSE v END ELSE v END"""
_UNIT = "CASE sensor_type WHEN 'temperature' THEN 'celsius' WHEN 'pressure' THEN 'bar' ELSE measurement_unit END"


@query("unit_convert", out(f"""
    SELECT id, sensor_type, {_CONV} AS measurement_value, {_UNIT} AS measurement_unit
    FROM (SELECT *, try_cast(measurement_value AS DOUBLE) AS v FROM raw_text)""", dbl="measurement_value", views="raw_text"))
def unit_convert(spark, sf):
    raw = B.raw_text(spark, sf)
    value, unit = scalars.convert_units(
        F.col("measurement_value").try_cast("double"), F.col("measurement_unit"), F.col("sensor_type"))
    return raw.select("id", "sensor_type", value.alias("measurement_value"), unit.alias("measurement_unit"))


@query("parse_ts", out(f"SELECT id, {_PARSED} AS parsed FROM raw_text", ts="parsed", views="raw_text"))
def parse_ts(spark, sf):
    return B.raw_text(spark, sf).select("id", scalars.parse_time(F.col("measurement_timestamp")).alias("parsed"))


@query("id_normalise", out(r"""
    SELECT upper(regexp_replace(trim(sensor_id), '[\s_./-]+', '-', 'g')) AS sensor_id, count(*) AS readings
    FROM raw_text GROUP BY 1""", views="raw_text"))
def id_normalise(spark, sf):
    return B.raw_text(spark, sf).groupBy(scalars.normalise_id(F.col("sensor_id")).alias("sensor_id")).agg(
        F.count(F.lit(1)).alias("readings"))


@query("json_fields", out("""
    SELECT 'payload' AS source, CAST(json_extract_string(props, '$.k') AS BIGINT) AS field, count(*) AS uses, sum(value) AS amount
    FROM events GROUP BY 2
    UNION ALL SELECT 'parts_used', o_custkey + i, count(*), sum(i)::DOUBLE FROM orders, range(1, 4) r(i) WHERE i <= o_orderkey % 4 GROUP BY 2""", dbl="amount"))
def json_fields(spark, sf):
    """A field of the payload object, and the elements of the parts array."""
    payload = B.table(spark, sf, "events").groupBy(
        F.lit("payload").alias("source"), scalars.json_number(F.col("props"), "$.k").alias("field")
    ).agg(F.count(F.lit(1)).alias("uses"), F.sum("value").alias("amount"))
    parts = B.parts_used(spark, sf).select(F.explode(scalars.parts_array(F.col("parts_used_json"))).alias("p"))
    used = parts.groupBy(F.lit("parts_used").alias("source"), F.col("p.part").alias("field")).agg(
        F.count(F.lit(1)).alias("uses"), F.sum("p.qty").alias("amount"))
    return payload.unionByName(used)


@query("wide_long", out(" UNION ALL ".join(
    f"SELECT aircraft_id, date, '{c}' AS sensor_type, {c} AS measurement_value FROM daily WHERE {c} IS NOT NULL" for c in S4),
    dbl="measurement_value", date="date", views="daily"))
def wide_long(spark, sf):
    wide = B.daily_wide(spark, sf)
    return wide.unpivot(["aircraft_id", "date"], S4, "sensor_type", "measurement_value").where("measurement_value IS NOT NULL")


@query("long_wide", out("SELECT * FROM daily WHERE coalesce(temperature, vibration, pressure, rpm) IS NOT NULL",
                        dbl=" ".join(S4), date="date", views="daily"))
def long_wide(spark, sf):
    r = B.readings(spark, sf).where(F.col("sensor_type").isin(S4))
    return r.groupBy("aircraft_id", F.to_date("measurement_timestamp").alias("date")).pivot("sensor_type", S4).agg(
        F.avg("measurement_value"))


@query("severity_tier", out("""
    SELECT CASE WHEN downtime_hours > 48 THEN 'critical' WHEN downtime_hours > 24 THEN 'major' WHEN downtime_hours > 4 THEN 'minor'
        ELSE 'negligible' END AS severity, maintenance_type, count(*) AS events, sum(downtime_hours) AS downtime_hours
    FROM maintenance GROUP BY 1, 2""", dbl="downtime_hours", views="maintenance"))
def severity_tier(spark, sf):
    m = B.maintenance(spark, sf)
    return m.groupBy(scalars.severity(F.col("downtime_hours")).alias("severity"), "maintenance_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("downtime_hours").alias("downtime_hours"))


@query("taxonomy_map", out("""
    SELECT coalesce(component_type, 'unknown') AS component_type, count(*) AS parts, min(p_partkey) AS first_part
    FROM part LEFT JOIN taxonomy ON part_category = p_type GROUP BY 1""", views="taxonomy"))
def taxonomy_map(spark, sf):
    parts = B.table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("part_category"))
    mapped = joins.with_default(parts, B.taxonomy(spark, sf), "part_category", "component_type", "unknown")
    return mapped.groupBy("component_type").agg(F.count(F.lit(1)).alias("parts"), F.min("p_partkey").alias("first_part"))


@query("maint_silver", out("""
    SELECT o_orderkey AS event_id, CASE o_orderstatus WHEN 'F' THEN 'corrective' WHEN 'O' THEN 'unscheduled' ELSE 'scheduled' END AS maintenance_type,
        hours AS duration_hours, CASE WHEN o_orderstatus IN ('F', 'O') THEN hours ELSE 0.0 END AS downtime_hours,
        CASE WHEN o_orderstatus = 'P' THEN 'negligible' WHEN hours > 48 THEN 'critical' WHEN hours > 24 THEN 'major' WHEN hours > 4 THEN 'minor' ELSE 'negligible' END AS failure_severity,
        parts::INTEGER AS parts_replaced_count, coalesce(component_type, 'unknown') AS component_type
    FROM (SELECT *, (o_orderkey % 60)::DOUBLE AS hours, o_orderkey % 4 AS parts FROM orders)
    LEFT JOIN part ON p_partkey = o_custkey + 1 AND parts > 0 LEFT JOIN taxonomy ON part_category = p_type""",
    dbl="duration_hours downtime_hours", views="taxonomy"))
def maint_silver(spark, sf):
    orders, part = B.table(spark, sf, "orders"), B.table(spark, sf, "part")
    used = B.parts_used(spark, sf)
    start = F.col("o_orderdate").cast("timestamp")
    kind = F.when(F.col("o_orderstatus") == "F", "corrective").when(F.col("o_orderstatus") == "O", "unscheduled").otherwise("scheduled")
    events = orders.join(used, orders.o_orderkey == used.order_id, "left").select(
        F.col("o_orderkey").alias("event_id"), kind.alias("maintenance_type"), start.alias("actual_start_date"),
        (start + F.make_dt_interval(hours=(F.col("o_orderkey") % 60).cast("int"))).alias("actual_end_date"),
        "parts_used_json", scalars.parts_array(F.col("parts_used_json"))[0]["part"].alias("_part"),
    )
    typed = events.join(part.select(F.col("p_partkey").alias("_part"), F.col("p_type").alias("part_category")), "_part", "left")
    silver = cleaning.silver_maintenance(typed, B.taxonomy(spark, sf), "parts_used_json")
    return silver.select("event_id", "maintenance_type", "duration_hours", "downtime_hours", "failure_severity",
                         "parts_replaced_count", "component_type")


_STATUS = """CASE WHEN quantity_available <= 0 THEN 'out_of_stock' WHEN quantity_available <= reorder_point THEN 'low_stock'
    WHEN quantity_available > reorder_point * 3 THEN 'overstock' ELSE 'in_stock' END"""


@query("inv_silver", out(f"""
    SELECT part_number, snapshot_date, quantity_available, stock_status, quantity_on_hand * unit_cost AS total_value,
        CASE WHEN stock_status = 'out_of_stock' AND lead_time_days >= 14 THEN 'high'
            WHEN stock_status IN ('out_of_stock', 'low_stock') THEN 'medium' ELSE 'low' END AS criticality_level
    FROM (SELECT *, {_STATUS} AS stock_status FROM inventory)""", dbl="total_value", date="snapshot_date", views="inventory"))
def inv_silver(spark, sf):
    return cleaning.silver_inventory(B.inventory(spark, sf)).select(
        "part_number", "snapshot_date", "quantity_available", "stock_status", "total_value", "criticality_level")


@query("silver_readings", out("""
    SELECT id AS source_record_id, sensor_id, measurement_timestamp, value AS measurement_value, measurement_unit,
        is_imputed, imputation_method, is_outlier,
        CASE WHEN value IS NULL THEN 0.0 ELSE (CASE WHEN is_imputed THEN 0.7 ELSE 1.0 END) * (CASE WHEN is_outlier THEN 0.5 ELSE 1.0 END) END AS quality_score
    FROM (SELECT f.*, coalesce((CASE WHEN q3 = q1 THEN CASE WHEN greatest(q1 - value, value - q3, 0.0) > 0 THEN 999.0 ELSE 0.0 END
            ELSE greatest(q1 - value, value - q3, 0.0) / (q3 - q1) END) > 3.0 OR (sensor_type = 'temperature' AND value NOT BETWEEN -50 AND 200)
            OR (sensor_type = 'vibration' AND value NOT BETWEEN 0 AND 100) OR (sensor_type = 'pressure' AND value NOT BETWEEN 0 AND 1000), false) AS is_outlier
        FROM filled f JOIN (SELECT sensor_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM filled GROUP BY 1) USING (sensor_type))
    """, dbl="measurement_value quality_score", ts="measurement_timestamp", views="filled"))
def silver_readings(spark, sf):
    """From text rows to cleaned readings; rows without a usable time cannot be placed and go to quarantine."""
    good = _conformed(spark, sf).where(F.col("measurement_timestamp").isNotNull()).drop("_errors")
    silver = cleaning.silver_readings(good, width=ordered.DAY)
    return silver.select("source_record_id", "sensor_id", "measurement_timestamp", "measurement_value", "measurement_unit",
                         "is_imputed", "imputation_method", "is_outlier", "quality_score")
