"""The bindings once more, as plain SQL, for the independent answers."""

_SENSOR = (
    "CASE event_type WHEN 'click' THEN 'temperature' WHEN 'view' THEN 'vibration' "
    "WHEN 'signup' THEN 'pressure' WHEN 'purchase' THEN 'rpm' ELSE event_type END"
)
S4 = ["temperature", "vibration", "pressure", "rpm"]
_WIDE = ", ".join(f"avg(measurement_value) FILTER (WHERE sensor_type = '{s}') AS {s}" for s in S4)

# name -> (views it needs, text)
VIEWS = {
    "readings": ("", f"""SELECT event_id AS id, user_id AS aircraft_id, user_id || '-' || {_SENSOR} AS sensor_id,
        {_SENSOR} AS sensor_type, ts AS measurement_timestamp, value AS measurement_value,
        props AS raw_data_json FROM events"""),
    "daily": ("readings", f"""SELECT aircraft_id, measurement_timestamp::DATE AS date, {_WIDE}
        FROM readings GROUP BY 1, 2"""),
    "failures": ("readings", """SELECT id, aircraft_id, measurement_timestamp AS failure_ts,
        measurement_value AS magnitude FROM readings WHERE sensor_type = 'error' AND measurement_value >= 100"""),
    "labeled0": ("readings", f"""SELECT aircraft_id, measurement_timestamp::DATE AS date, {_WIDE},
        avg(measurement_value) FILTER (WHERE sensor_type = 'error') AS altitude,
        avg(measurement_value) AS ambient_temp, count(*)::DOUBLE AS flight_hours,
        max(CASE WHEN sensor_type = 'error' AND measurement_value >= 100 THEN 1 ELSE 0 END) AS failed
        FROM readings GROUP BY 1, 2"""),
    "labeled1": ("labeled0", """SELECT *, (row_number() OVER (PARTITION BY aircraft_id ORDER BY date) - 1)::INTEGER AS cycle,
        date_diff('day', date, min(CASE WHEN failed = 1 THEN date END) OVER (PARTITION BY aircraft_id ORDER BY date
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::INTEGER AS days_to_failure FROM labeled0"""),
    "labeled": ("labeled1", """SELECT aircraft_id, date, cycle, temperature, vibration, pressure, rpm, altitude,
        ambient_temp, flight_hours, failed, days_to_failure,
        CASE WHEN days_to_failure <= 7 THEN 1 ELSE 0 END AS will_fail_7days FROM labeled1"""),
    "history0": ("", """SELECT l_suppkey AS aircraft_id, l_shipdate::DATE AS date, avg(l_quantity) AS temperature, avg(l_discount * 100) AS vibration,
        avg(l_extendedprice / 1000) AS pressure, avg(l_tax * 100) AS rpm, max(l_extendedprice) AS altitude, min(l_quantity) AS ambient_temp,
        count(*)::DOUBLE AS flight_hours, max(CASE WHEN l_returnflag = 'R' AND l_quantity >= 45 THEN 1 ELSE 0 END) AS failed FROM lineitem GROUP BY 1, 2"""),
    "history": ("history0", """SELECT *, CASE WHEN days_to_failure <= 7 THEN 1 ELSE 0 END AS will_fail_7days FROM (SELECT *,
        (row_number() OVER (PARTITION BY aircraft_id ORDER BY date) - 1)::INTEGER AS cycle,
        date_diff('day', date, min(CASE WHEN failed = 1 THEN date END) OVER (PARTITION BY aircraft_id ORDER BY date
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::INTEGER AS days_to_failure FROM history0)"""),
    "maintenance": ("readings", """SELECT id, aircraft_id, measurement_timestamp AS start_ts,
        CASE WHEN measurement_value >= 50 THEN 'corrective' ELSE 'preventive' END AS maintenance_type,
        measurement_value AS downtime_hours, measurement_value AS cost_usd,
        CAST(json_extract_string(raw_data_json, '$.k') AS INTEGER) AS labor_hours
        FROM readings WHERE sensor_type = 'rpm'"""),
    "inventory": ("", """SELECT p_partkey AS part_number, p_name AS part_name, p_type AS part_category,
        snapshot_date, quantity_on_hand, quantity_reserved,
        quantity_on_hand - quantity_reserved AS quantity_available, p_size AS reorder_point,
        p_retailprice AS unit_cost, supplier_id, p_size % 15 + 7 AS lead_time_days
        FROM (SELECT l_partkey, l_shipdate::DATE AS snapshot_date, sum(l_quantity::INTEGER)::INTEGER AS quantity_on_hand,
            coalesce(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity::INTEGER END), 0)::INTEGER AS quantity_reserved,
            min(l_suppkey) AS supplier_id FROM lineitem GROUP BY 1, 2) s
        JOIN part ON p_partkey = l_partkey"""),
    "fleet": ("", """SELECT c_custkey AS aircraft_id, c_mktsegment AS model, c_nationkey + 1990 AS manufacture_year,
        c_acctbal AS total_flight_hours, n_name AS location
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "status_changes": ("", """SELECT o_custkey AS aircraft_id, o_orderstatus AS status, o_orderdate AS changed_at,
        o_orderkey AS change_id FROM orders"""),
    "scored0": ("readings", """SELECT aircraft_id, measurement_timestamp::DATE AS prediction_date,
        round(least(1.0, avg(measurement_value) / 200) + 1e-9, 4) AS failure_probability,
        max(CASE WHEN sensor_type = 'error' AND measurement_value >= 100 THEN 1 ELSE 0 END) AS failed
        FROM readings GROUP BY 1, 2"""),
    "scored1": ("scored0", """SELECT *, date_diff('day', prediction_date,
        min(CASE WHEN failed = 1 THEN prediction_date END) OVER (PARTITION BY aircraft_id ORDER BY prediction_date
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS gap FROM scored0"""),
    "scored": ("scored1", """SELECT aircraft_id, prediction_date, failure_probability,
        CASE WHEN gap <= 7 THEN 1 ELSE 0 END AS label,
        CASE WHEN failure_probability >= 0.25 THEN 1 ELSE 0 END AS prediction FROM scored1"""),
    "engines": ("readings", """SELECT aircraft_id AS engine_id, id, measurement_timestamp, sensor_type, measurement_value,
        row_number() OVER (PARTITION BY aircraft_id ORDER BY measurement_timestamp, id) AS cycle FROM readings"""),
    "raw_text": ("readings", """SELECT id, aircraft_id::VARCHAR AS aircraft_id,
        '  ac_' || aircraft_id || '. ' || sensor_type AS sensor_id, sensor_type,
        CASE WHEN id % 97 = 0 THEN 'not a time' WHEN id % 3 = 0 THEN strftime(measurement_timestamp, '%Y-%m-%d %H:%M:%S')
             WHEN id % 3 = 1 THEN strftime(measurement_timestamp, '%Y-%m-%dT%H:%M:%S')
             ELSE strftime(measurement_timestamp, '%Y-%m-%d %H:%M:%S.%f') END AS measurement_timestamp,
        CASE WHEN id % 89 = 0 THEN 'n/a' ELSE measurement_value::VARCHAR END AS measurement_value,
        CASE sensor_type WHEN 'temperature' THEN CASE id % 3 WHEN 0 THEN 'fahrenheit' WHEN 1 THEN 'celsius' ELSE 'kelvin' END
             WHEN 'pressure' THEN CASE id % 3 WHEN 0 THEN 'psi' WHEN 1 THEN 'bar' ELSE 'pascal' END END AS measurement_unit
        FROM readings"""),
    "gappy": ("readings", """SELECT id, aircraft_id, sensor_id, sensor_type, measurement_timestamp,
        CASE WHEN CAST(json_extract_string(raw_data_json, '$.k') AS INTEGER) >= 20 THEN measurement_value END AS measurement_value
        FROM readings"""),
    "taxonomy": ("", """SELECT DISTINCT p_type AS part_category, 'component-' || lower(p_type) AS component_type
        FROM part WHERE p_type NOT IN ('PROMO', 'SMALL')"""),
}

VIEWS["std"] = ("raw_text", r"""SELECT id, aircraft_id, upper(regexp_replace(trim(sensor_id), '[\s_./-]+', '-', 'g')) AS sensor_id, sensor_type,
    coalesce(try_strptime(measurement_timestamp, '%Y-%m-%d %H:%M:%S'), try_strptime(measurement_timestamp, '%Y-%m-%dT%H:%M:%S'),
        try_strptime(measurement_timestamp, '%Y-%m-%d %H:%M:%S.%f')) AS t,
    CASE sensor_type WHEN 'temperature' THEN CASE measurement_unit WHEN 'fahrenheit' THEN (v - 32) * 5 / 9 WHEN 'kelvin' THEN v - 273.15::DOUBLE ELSE v END
        WHEN 'pressure' THEN CASE measurement_unit WHEN 'psi' THEN v * 0.0689476::DOUBLE WHEN 'pascal' THEN v / 100000 ELSE v END ELSE v END AS v,
    CASE sensor_type WHEN 'temperature' THEN 'celsius' WHEN 'pressure' THEN 'bar' ELSE measurement_unit END AS measurement_unit
    FROM (SELECT *, try_cast(measurement_value AS DOUBLE) AS v FROM raw_text) WHERE id % 97 <> 0""")
VIEWS["spots"] = ("std", """SELECT *, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER w AS last_t,
    last_value(v IGNORE NULLS) OVER w AS last_v, last_value(CASE WHEN v IS NOT NULL THEN nulls END IGNORE NULLS) OVER w AS last_nulls
    FROM (SELECT *, sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY sensor_id ORDER BY t, id) AS nulls FROM std)
    WINDOW w AS (PARTITION BY sensor_id ORDER BY t, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
VIEWS["filled"] = ("spots", """SELECT id, sensor_id, sensor_type, t AS measurement_timestamp, measurement_unit,
    CASE WHEN v IS NOT NULL THEN v WHEN short THEN last_v ELSE med END AS value,
    v IS NULL AND (short OR med IS NOT NULL) AS is_imputed,
    CASE WHEN v IS NOT NULL THEN NULL WHEN short THEN 'forward_fill' WHEN med IS NOT NULL THEN 'median' END AS imputation_method
    FROM (SELECT g.*, coalesce(g.t - g.last_t <= INTERVAL 60 MINUTE AND g.nulls - g.last_nulls <= 5, false) AS short,
        (SELECT median(r.v) FROM std r WHERE r.sensor_id = g.sensor_id AND r.t >= g.t - INTERVAL 24 HOUR AND r.t < g.t) AS med FROM spots g)""")


def _ff(c, part="aircraft_id", order="date"):
    return (f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({c} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))")


_other = "aircraft_id, date, cycle, altitude, ambient_temp, flight_hours, failed, days_to_failure, will_fail_7days"
VIEWS["gold_fill"] = ("labeled", f"SELECT {_other}, {', '.join(f'{_ff(c)} AS {c}' for c in S4)} FROM labeled")
VIEWS["gold_lim"] = ("gold_fill", "SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}" for c in S4) + " FROM gold_fill")
VIEWS["gold_silver"] = ("gold_fill gold_lim", f"SELECT {_other}, " + ", ".join(
    f"CASE WHEN {c} IS NOT NULL THEN greatest(a_{c} - 3 * (b_{c} - a_{c}), least(b_{c} + 3 * (b_{c} - a_{c}), {c})) END AS {c}"
    for c in S4) + " FROM gold_fill, gold_lim")
_KEYS = "aircraft_id, sensor_id, sensor_type"
VIEWS["hours"] = ("readings", f"""SELECT {_KEYS}, date_trunc('hour', measurement_timestamp) AS feature_timestamp,
    arg_max(measurement_value, (measurement_timestamp, measurement_value)) AS value_current, avg(measurement_value) AS mean FROM readings
    GROUP BY ALL""")
VIEWS["flagged0"] = ("readings", """SELECT *, abs(measurement_value - q2) / ((q3 - q1) / 1.349::DOUBLE + 1e-6) AS z FROM readings JOIN
    (SELECT sensor_type, quantile_cont(measurement_value, 0.25) AS q1, quantile_cont(measurement_value, 0.5) AS q2,
        quantile_cont(measurement_value, 0.75) AS q3 FROM readings GROUP BY 1) USING (sensor_type)""")
VIEWS["flagged"] = ("flagged0", """SELECT *, z / (z + 1) AS anomaly_score,
    z / (z + 1) > (SELECT quantile_cont(z / (z + 1), 0.95) FROM flagged0) AS is_anomaly FROM flagged0""")
VIEWS["acdays0"] = ("flagged", """SELECT aircraft_id, measurement_timestamp::DATE AS feature_date, sensor_type, count(*) AS n,
    sum(anomaly_score) AS score, max(is_anomaly::INTEGER) AS odd, max(anomaly_score) AS top,
    max(CASE WHEN (sensor_type = 'temperature' AND measurement_value >= 150) OR (sensor_type = 'vibration' AND measurement_value >= 80) THEN 1 ELSE 0 END) AS over_limit
    FROM flagged GROUP BY ALL""")
VIEWS["acdays1"] = ("acdays0 fleet failures", """SELECT d.*, coalesce(f.failed, 0) AS failed_today, model FROM (
    SELECT aircraft_id, feature_date, sum(n)::BIGINT AS flight_cycles_today, sum(n)::DOUBLE AS flight_hours_today,
        sum(odd)::BIGINT AS sensors_with_anomalies_count, sum(score) / sum(n) AS avg_anomaly_score,
        sum(over_limit)::BIGINT AS critical_sensors_count, count(*) FILTER (WHERE top >= 0.75) AS components_high_risk_count,
        coalesce(string_agg(CASE WHEN odd = 1 THEN sensor_type END, ',' ORDER BY sensor_type), '') AS pattern
    FROM acdays0 GROUP BY ALL) d LEFT JOIN fleet USING (aircraft_id)
    LEFT JOIN (SELECT aircraft_id, failure_ts::DATE AS feature_date, count(*) AS failed FROM failures GROUP BY ALL) f USING (aircraft_id, feature_date)""")
VIEWS["acdays"] = ("acdays1 maintenance failures", """SELECT aircraft_id, feature_date, flight_hours_today, flight_cycles_today,
    sum(flight_hours_today) OVER w AS cumulative_flight_hours, (sum(flight_cycles_today) OVER w)::BIGINT AS cumulative_flight_cycles,
    date_diff('day', (SELECT max(start_ts::DATE) FROM maintenance m WHERE m.aircraft_id = a.aircraft_id AND m.start_ts::DATE <= a.feature_date), feature_date)::INTEGER AS days_since_last_maintenance,
    date_diff('day', feature_date, (SELECT min(start_ts::DATE) FROM maintenance m WHERE m.aircraft_id = a.aircraft_id AND maintenance_type = 'preventive' AND m.start_ts::DATE >= a.feature_date))::INTEGER AS days_until_next_scheduled_maintenance,
    (SELECT count(*) FROM maintenance m WHERE m.aircraft_id = a.aircraft_id AND m.start_ts::DATE BETWEEN a.feature_date - 30 AND a.feature_date) AS maintenance_events_last_30d,
    (SELECT count(*) FROM failures m WHERE m.aircraft_id = a.aircraft_id AND m.failure_ts::DATE BETWEEN a.feature_date - 90 AND a.feature_date) AS failure_events_last_90d,
    (SELECT count(*) FROM failures m WHERE m.aircraft_id = a.aircraft_id AND m.failure_ts::DATE BETWEEN a.feature_date - 90 AND a.feature_date) > 0 AS failure_history_indicator,
    sensors_with_anomalies_count, avg_anomaly_score, critical_sensors_count, components_high_risk_count, 1 - avg_anomaly_score AS health_index,
    coalesce(sum(failed_today) OVER (PARTITION BY model, pattern ORDER BY feature_date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING), 0)::BIGINT AS similar_failure_history_count
    FROM acdays1 a WINDOW w AS (PARTITION BY aircraft_id ORDER BY feature_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
VIEWS["latest_stock"] = ("inventory", "SELECT * FROM inventory QUALIFY row_number() OVER (PARTITION BY part_number ORDER BY snapshot_date DESC) = 1")
VIEWS["scd_once"] = ("status_changes", "SELECT aircraft_id, changed_at, arg_max(status, change_id) AS status FROM status_changes GROUP BY 1, 2")
VIEWS["scd_start"] = ("scd_once", """SELECT aircraft_id, changed_at, status FROM (SELECT *, lag(status) OVER (PARTITION BY aircraft_id ORDER BY changed_at) AS before,
    row_number() OVER (PARTITION BY aircraft_id ORDER BY changed_at) AS rn FROM scd_once) WHERE rn = 1 OR status <> before""")
VIEWS["scd"] = ("scd_start", """SELECT aircraft_id, status, changed_at AS effective_start_date,
    coalesce(lead(changed_at) OVER w, TIMESTAMP '9999-12-31') AS effective_end_date, lead(changed_at) OVER w IS NULL AS is_current,
    (row_number() OVER w)::INTEGER AS version_number FROM scd_start WINDOW w AS (PARTITION BY aircraft_id ORDER BY changed_at)""")
