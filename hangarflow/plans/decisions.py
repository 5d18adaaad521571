"""Predictions, alerts, recommendations, KPIs, feedback and drift."""

from pyspark.sql import functions as F

from hangarflow import bindings as B, rules
from hangarflow.functions import scalars
from hangarflow.ml import evaluate
from hangarflow.operators import cleaning, decisions, gold, monitor
from hangarflow.plans.registry import out, query
from hangarflow.plans.sql_views import VIEWS
from hangarflow.session import work_dir
from hangarflow.sources import tables

TODAY = "2024-01-30"
_RISK = "CASE WHEN {p} >= 0.75 THEN 'critical' WHEN {p} >= 0.5 THEN 'high' WHEN {p} >= 0.25 THEN 'medium' ELSE 'low' END"


def _preds(spark, sf):
    return decisions.predictions(B.scored(spark, sf))


VIEWS["contrib"] = ("readings", """SELECT aircraft_id, prediction_date, arg_min(sensor_type, r) AS most_likely_component,
    to_json(list({'sensor': sensor_type, 'contribution': share} ORDER BY r))::VARCHAR AS contributing_sensors_json
    FROM (SELECT *, row_number() OVER (PARTITION BY aircraft_id, prediction_date ORDER BY share DESC, sensor_type) AS r
        FROM (SELECT aircraft_id, measurement_timestamp::DATE AS prediction_date, sensor_type,
            round(100 * sum(measurement_value) / sum(sum(measurement_value)) OVER (PARTITION BY aircraft_id, measurement_timestamp::DATE) + 1e-9, 2) AS share
            FROM readings GROUP BY 1, 2, 3)) WHERE r <= 3 GROUP BY 1, 2""")
VIEWS["preds"] = ("scored", f"""SELECT *, failure_probability >= 0.5 AS failure_prediction, {_RISK.format(p='failure_probability')} AS risk_level FROM scored""")
VIEWS["alerts_p"] = ("preds", """SELECT sha256(aircraft_id || '|' || strftime(prediction_date, '%Y-%m-%d') || '|' || rule) AS alert_id, aircraft_id,
    prediction_date::TIMESTAMP AS alert_timestamp, 'predictive_failure' AS alert_type, rule, severity, 'open' AS status, failure_probability,
    CASE severity WHEN 'critical' THEN 'Schedule immediate maintenance inspection' WHEN 'high' THEN 'Schedule maintenance within 48 hours' ELSE 'Monitor and plan maintenance within 7 days' END AS recommended_action,
    CASE severity WHEN 'critical' THEN 'immediate' WHEN 'high' THEN 'within_24h' ELSE 'within_7d' END AS recommended_timeframe,
    CASE severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 ELSE 2 END AS dashboard_priority
    FROM (SELECT *, risk_level AS severity, risk_level || '_failure_risk' AS rule FROM preds WHERE failure_probability >= 0.25)""")
VIEWS["alerts_t"] = ("readings", """SELECT sha256(id || '|' || rule) AS alert_id, aircraft_id, measurement_timestamp AS alert_timestamp,
    'threshold_exceeded' AS alert_type, rule, severity, 'open' AS status, measurement_value AS observed, threshold
    FROM readings JOIN (VALUES ('temperature_critical', 'temperature', 150.0::DOUBLE, 'critical'), ('vibration_high', 'vibration', 80.0::DOUBLE, 'high')) r(rule, kind, threshold, severity)
    ON kind = sensor_type AND measurement_value >= threshold""")
VIEWS["gap"] = ("maintenance", """SELECT avg(cost_usd) FILTER (WHERE maintenance_type = 'corrective') AS c, avg(cost_usd) FILTER (WHERE maintenance_type = 'preventive') AS p FROM maintenance""")
VIEWS["demand"] = ("preds", f"""SELECT slot, count(*) AS n_aircraft, sum(n)::INTEGER AS d7, string_agg(aircraft_id::VARCHAR, ',' ORDER BY aircraft_id) AS aircraft FROM
    (SELECT aircraft_id % 40 AS slot, aircraft_id, count(*) AS n FROM preds WHERE failure_probability >= 0.5 AND prediction_date > DATE '{TODAY}' - 7
        AND prediction_date <= DATE '{TODAY}' GROUP BY 1, 2) GROUP BY 1""")
VIEWS["recs0"] = ("latest_stock demand", """SELECT s.*, coalesce(d7, 0) AS d7, round(coalesce(d7, 0) * 30 / 7.0::DOUBLE)::INTEGER AS d30, 
    quantity_available AS a, reorder_point AS rp FROM latest_stock s LEFT JOIN demand ON demand.slot = part_number % 40""")
VIEWS["recs1"] = ("recs0", """SELECT *, CASE WHEN a < d7 THEN 'expedite' WHEN a - d30 < rp THEN 'order' WHEN a > 0 AND a > rp * 3 AND d30 = 0 THEN 'reduce' ELSE 'no_action' END AS kind FROM recs0""")
VIEWS["recs"] = ("recs1 gap", f"""SELECT DATE '{TODAY}' AS recommendation_date, part_number, part_name, quantity_on_hand AS current_quantity, quantity_reserved AS current_reserved,
    a AS current_available, d7 AS predicted_demand_7d, d30 AS predicted_demand_30d, kind AS recommendation_type, greatest(0, d30 + rp - a) AS recommended_order_quantity,
    CASE WHEN kind = 'expedite' OR a <= 0 THEN 'urgent' WHEN a <= rp THEN 'high' WHEN kind = 'order' THEN 'normal' ELSE 'low' END AS recommended_priority,
    d7 AS related_predictions_count, part_number % 40 AS slot,
    CASE WHEN d30 > 0 THEN DATE '{TODAY}' + floor(a * 30 / d30::DOUBLE)::INTEGER END AS expected_stockout_date,
    greatest(0, d30 + rp - a) * unit_cost AS estimated_cost, d7 * (gap.c - gap.p) AS potential_downtime_cost_avoided FROM recs1, gap""")


@query("predictions", out("""
    SELECT p.aircraft_id, p.prediction_date, failure_probability, failure_prediction, risk_level, p.prediction_date AS predicted_failure_window_start,
        p.prediction_date + 7 AS predicted_failure_window_end, 'baseline' AS model_id, '1.0' AS model_version,
        greatest(failure_probability, 1 - failure_probability) AS prediction_confidence,
        sha256(p.aircraft_id || '|' || strftime(p.prediction_date, '%Y-%m-%d')) AS feature_snapshot_id, most_likely_component, contributing_sensors_json
    FROM preds p LEFT JOIN contrib c ON c.aircraft_id = p.aircraft_id AND c.prediction_date = p.prediction_date""",
    dbl="failure_probability prediction_confidence", date="prediction_date predicted_failure_window_start predicted_failure_window_end", views="preds contrib"))
def predictions(spark, sf):
    return decisions.predictions(B.scored(spark, sf), decisions.contributions(B.readings(spark, sf)))


@query("alerts_predictive", out("SELECT * FROM alerts_p", dbl="failure_probability", ts="alert_timestamp", views="alerts_p"))
def alerts_predictive(spark, sf):
    return decisions.predictive_alerts(_preds(spark, sf))


@query("alerts_threshold", out("SELECT * FROM alerts_t", dbl="observed threshold", ts="alert_timestamp", views="alerts_t"))
def alerts_threshold(spark, sf):
    return decisions.threshold_alerts(B.readings(spark, sf))


def _slotted(spark, sf):
    return _preds(spark, sf).withColumn("slot", F.col("aircraft_id") % B.SLOTS)


@query("inv_aircraft", out("SELECT slot, n_aircraft AS aircraft, aircraft AS related_aircraft_list FROM demand", views="demand"))
def inv_aircraft(spark, sf):
    return decisions.aircraft_lists(decisions.related_aircraft(_slotted(spark, sf), TODAY, "slot"), "slot")


def _recs(spark, sf):
    preds = _slotted(spark, sf)
    stock = gold.latest_stock(B.inventory(spark, sf)).withColumn("slot", F.col("part_number") % B.SLOTS)
    return decisions.recommend(preds, stock, TODAY, decisions.cost_gap(B.maintenance(spark, sf)), "slot")


@query("inv_recommend", out("SELECT * FROM recs", dbl="estimated_cost potential_downtime_cost_avoided",
                            date="recommendation_date expected_stockout_date", views="recs"))
def inv_recommend(spark, sf):
    return _recs(spark, sf)


VIEWS["day_alerts"] = ("alerts_p alerts_t scd", f"""SELECT * FROM (SELECT alert_id, aircraft_id, alert_timestamp, severity, status FROM alerts_p
        UNION ALL SELECT alert_id, aircraft_id, alert_timestamp, severity, status FROM alerts_t)
    WHERE alert_timestamp::DATE = DATE '{TODAY}' AND aircraft_id IN (SELECT aircraft_id FROM scd WHERE is_current)""")
VIEWS["day_weights"] = ("day_alerts scd", """SELECT aircraft_id, greatest(any_value(coalesce(fired, 0)), 1) * count(*) AS weight
    FROM (SELECT aircraft_id FROM scd WHERE is_current) LEFT JOIN (SELECT aircraft_id, count(*) AS fired FROM day_alerts GROUP BY 1) USING (aircraft_id) GROUP BY 1""")


@query("kpi_summary", out(f"""
    WITH open_now AS (SELECT severity, count(DISTINCT alert_id) AS n FROM day_alerts WHERE status = 'open' GROUP BY 1),
    today_preds AS (SELECT aircraft_id, failure_probability, risk_level, weight FROM preds JOIN day_weights USING (aircraft_id) WHERE prediction_date = DATE '{TODAY}'),
    by_risk AS (SELECT risk_level, count(DISTINCT aircraft_id) AS n FROM today_preds GROUP BY 1)
    SELECT DATE '{TODAY}' AS kpi_date, (SELECT count(*) FROM day_weights) AS total_aircraft,
        (SELECT count(DISTINCT aircraft_id) FROM scd WHERE is_current AND status = 'O') AS active_aircraft,
        coalesce((SELECT n FROM open_now WHERE severity = 'critical'), 0) AS critical_alerts_open,
        coalesce((SELECT n FROM open_now WHERE severity = 'high'), 0) AS high_alerts_open,
        (SELECT count(DISTINCT alert_id) FROM day_alerts) AS total_alerts_today,
        (SELECT sum(weight * failure_probability) / sum(weight) FROM today_preds WHERE failure_probability IS NOT NULL) AS avg_failure_probability,
        coalesce((SELECT n FROM by_risk WHERE risk_level = 'critical'), 0) AS aircraft_critical_risk,
        coalesce((SELECT n FROM by_risk WHERE risk_level = 'high'), 0) AS aircraft_high_risk,
        (SELECT count(DISTINCT part_number) FROM recs WHERE recommendation_date = DATE '{TODAY}'
            AND (recommendation_type, recommended_priority) = ('order', 'urgent')) AS urgent_part_orders""",
    dbl="avg_failure_probability", date="kpi_date", views="day_weights preds recs"))
def kpi_summary(spark, sf):
    versions = tables.scd2(B.status_changes(spark, sf), "aircraft_id", "changed_at", "status", "change_id")
    state = F.when(F.col("status") == "O", "active").when(F.col("status") == "P", "maintenance").otherwise("retired")
    dim = versions.select("aircraft_id", state.alias("operational_status"), "is_current")
    keep = ["alert_id", "aircraft_id", "alert_timestamp", "severity", "status"]
    preds = _preds(spark, sf)
    alerts = decisions.predictive_alerts(preds).select(*keep).unionByName(
        decisions.threshold_alerts(B.readings(spark, sf)).select(*keep))
    return decisions.kpi(dim, alerts, preds, _recs(spark, sf), TODAY)


VIEWS["judged"] = ("scored", """SELECT *, label = 1 AS actual_failure_occurred, CASE WHEN prediction = 1 AND label = 1 THEN 'true_positive'
    WHEN prediction = 1 THEN 'false_positive' WHEN label = 1 THEN 'false_negative' ELSE 'true_negative' END AS prediction_accuracy FROM scored""")


def _judged(spark, sf):
    return decisions.feedback(B.scored(spark, sf), B.failures(spark, sf))


@query("prediction_feedback", out("""SELECT s.aircraft_id, s.prediction_date, s.failure_probability, s.label, s.prediction,
        EXISTS (SELECT 1 FROM failures f WHERE f.aircraft_id = s.aircraft_id AND f.failure_ts::DATE BETWEEN s.prediction_date AND s.prediction_date + 7) AS actual_failure_occurred,
        prediction_accuracy FROM judged s""", dbl="failure_probability", date="prediction_date", views="judged failures"))
def prediction_feedback(spark, sf):
    return _judged(spark, sf)


@query("error_cost", out("""
    SELECT aircraft_id, count(*) FILTER (WHERE prediction_accuracy = 'false_negative') AS misses, count(*) FILTER (WHERE prediction_accuracy = 'false_positive') AS false_alarms,
        avg(failure_probability) FILTER (WHERE prediction_accuracy IN ('false_negative', 'false_positive')) AS mean_wrong_score,
        count(*) FILTER (WHERE prediction_accuracy = 'false_negative') * max(c) + count(*) FILTER (WHERE prediction_accuracy = 'false_positive') * max(p) AS cost
    FROM judged, gap GROUP BY 1""", dbl="mean_wrong_score cost", views="judged gap"))
def error_cost(spark, sf):
    return decisions.error_cost(_judged(spark, sf), B.maintenance(spark, sf))


@query("calibration", out("""
    SELECT least(9, floor(failure_probability * 10))::INTEGER AS bin, count(*) AS records, avg(failure_probability) AS mean_score, avg(label) AS observed_rate
    FROM scored GROUP BY 1""", dbl="mean_score observed_rate", views="scored"))
def calibration(spark, sf):
    return evaluate.calibration(B.scored(spark, sf))


@query("dataset_hash")
def dataset_hash(spark, sf):
    return decisions.fingerprint(B.table(spark, sf, "lineitem"))


_COUNTS = """count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS fp,
    count(*) FILTER (WHERE label = 1 AND prediction = 0)::DOUBLE AS fn, count(*) FILTER (WHERE label = 0 AND prediction = 0)::DOUBLE AS tn"""
_PREC, _REC = "coalesce(tp / nullif(tp + fp, 0), 0)", "coalesce(tp / nullif(tp + fn, 0), 0)"
_F1 = "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)"
_FPR = "coalesce(fp / nullif(fp + tn, 0), 0)"
VIEWS["weekly"] = ("scored", f"""SELECT week, {_PREC} AS "precision", {_REC} AS recall, {_F1} AS f1_score
    FROM (SELECT date_trunc('week', prediction_date)::DATE AS week, {_COUNTS} FROM scored GROUP BY 1)""")
VIEWS["psi_long"] = ("readings", "SELECT sensor_type, measurement_value AS v, measurement_timestamp >= TIMESTAMP '2024-01-16' AS now FROM readings")
VIEWS["psi_bin"] = ("psi_long", """SELECT sensor_type, now, len(list_filter(cuts, lambda c: c < v)) AS bin FROM psi_long JOIN
    (SELECT sensor_type, quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS cuts FROM psi_long WHERE NOT now GROUP BY 1) USING (sensor_type)""")
VIEWS["psi_share"] = ("psi_bin", """SELECT sensor_type, b AS bin, greatest(count(*) FILTER (WHERE NOT now AND bin = b)::DOUBLE / count(*) FILTER (WHERE NOT now), 1e-4) AS e,
    greatest(count(*) FILTER (WHERE now AND bin = b)::DOUBLE / count(*) FILTER (WHERE now), 1e-4) AS a FROM psi_bin, range(10) r(b) GROUP BY 1, 2""")
VIEWS["psi"] = ("psi_share psi_long", """SELECT sensor_type, (SELECT count(*) FROM psi_long l WHERE NOT now AND l.sensor_type = s.sensor_type) AS baseline_rows,
    (SELECT count(*) FROM psi_long l WHERE now AND l.sensor_type = s.sensor_type) AS current_rows, sum((a - e) * ln(a / e)) AS psi, sum((a - e) * ln(a / e)) > 0.2 AS drifted
    FROM psi_share s GROUP BY 1""")


@query("perf_trend", out("""SELECT *, arg_min(f1_score, week) OVER () AS baseline_f1, f1_score < 0.75 * arg_min(f1_score, week) OVER () AS degraded FROM weekly""",
                         dbl='"precision" recall f1_score baseline_f1', date="week", views="weekly"))
def perf_trend(spark, sf):
    return monitor.performance_trend(B.scored(spark, sf))


def _halves(spark, sf):
    r = B.readings(spark, sf).select("sensor_type", "measurement_timestamp", "measurement_value")
    cut = F.lit("2024-01-16").cast("timestamp")
    t = F.col("measurement_timestamp")
    return r.where(t < cut), r.where(t >= cut)


@query("drift_psi", out("SELECT * FROM psi", dbl="psi", views="psi"))
def drift_psi(spark, sf):
    return monitor.psi(*_halves(spark, sf), "measurement_value", "sensor_type")


@query("drift_ks", out("""
    SELECT max(a)::BIGINT AS baseline_rows, max(b)::BIGINT AS current_rows, max(abs(ca / a - cb / b)) AS ks_statistic,
        1.358::DOUBLE * sqrt((max(a) + max(b)) / (max(a) * max(b))) AS critical_value, max(abs(ca / a - cb / b)) > 1.358::DOUBLE * sqrt((max(a) + max(b)) / (max(a) * max(b))) AS drifted
    FROM (SELECT sum(CASE WHEN now THEN 0 ELSE 1 END) OVER (ORDER BY v)::DOUBLE AS ca, sum(CASE WHEN now THEN 1 ELSE 0 END) OVER (ORDER BY v)::DOUBLE AS cb,
        (count(*) FILTER (WHERE NOT now) OVER ())::DOUBLE AS a, (count(*) FILTER (WHERE now) OVER ())::DOUBLE AS b FROM psi_long)""",
    dbl="ks_statistic critical_value", views="psi_long"))
def drift_ks(spark, sf):
    return monitor.ks(*_halves(spark, sf), "measurement_value")


@query("retrain_trigger", out("""
    SELECT d AS performance_degradation, (SELECT bool_or(drifted) FROM psi) AS significant_drift, false AS manual_trigger, false AS scheduled_monthly,
        d OR (SELECT bool_or(drifted) FROM psi) AS retrain
    FROM (SELECT bool_or(f1_score < 0.75 * base) AS d FROM (SELECT f1_score, arg_min(f1_score, week) OVER () AS base FROM weekly))""", views="weekly psi"))
def retrain_trigger(spark, sf):
    drift = monitor.psi(*_halves(spark, sf), "measurement_value", "sensor_type")
    return monitor.retraining(monitor.performance_trend(B.scored(spark, sf)), drift)


VIEWS["by_model"] = ("scored", f"""SELECT model, {_PREC} AS "precision", {_REC} AS recall, {_F1} AS f1_score, {_FPR} AS false_positive_rate
    FROM (SELECT model, {_COUNTS.replace('prediction', 'said')} FROM (SELECT label, 'cut_' || cut AS model, CASE WHEN failure_probability >= cut / 100.0::DOUBLE THEN 1 ELSE 0 END AS said
        FROM scored, (VALUES (15), (25), (40)) c(cut)) GROUP BY 1)""")


def _by_model(spark, sf):
    """Three candidate models: the same score cut at different levels."""
    cut = F.explode(F.array(*[F.lit(c) for c in (15, 25, 40)]))
    each = B.scored(spark, sf).drop("prediction").select("*", cut.alias("cut")).select(
        "label", F.concat(F.lit("cut_"), F.col("cut").cast("string")).alias("model"),
        (F.col("failure_probability") >= F.col("cut") / 100).cast("int").alias("prediction"))
    return evaluate.metrics(each, prob=None, by="model")


@query("champion", out("""
    SELECT (SELECT model FROM by_model ORDER BY f1_score DESC, model LIMIT 1) AS champion, (SELECT model FROM by_model ORDER BY f1_score DESC, model LIMIT 1 OFFSET 1) AS fallback,
        (SELECT max(f1_score) FROM by_model) AS champion_score FROM by_model LIMIT 1""", dbl="champion_score", views="by_model"))
def champion(spark, sf):
    return evaluate.champion(_by_model(spark, sf))


@query("promotion_gate", out("""
    SELECT model, f1_score >= 0.85 AS f1_ok, recall >= 0.85 AS recall_ok, "precision" >= 0.75 AS precision_ok, false_positive_rate <= 0.30 AS fpr_ok,
        f1_score >= 0.85 AND recall >= 0.85 AND "precision" >= 0.75 AND false_positive_rate <= 0.30 AS promote FROM by_model""", views="by_model"))
def promotion_gate(spark, sf):
    return evaluate.promotion_gate(_by_model(spark, sf)).select("model", "f1_ok", "recall_ok", "precision_ok", "fpr_ok", "promote")


@query("run_log")
def run_log(spark, sf):
    """Two stages of a load, logged while they run."""
    log, silver, daily = work_dir(spark), work_dir(spark), work_dir(spark)
    gappy = B.gappy_readings(spark, sf)
    monitor.logged(gappy, lambda d: d.write.parquet(silver), log, "daily_load", "bronze_to_silver", "r1",
                   ["events"], "silver_sensor_data", failed=F.col("measurement_value").isNull())
    wide = B.daily_wide(spark, sf)
    monitor.logged(cleaning.impute(wide, rules.SENSORS, "forward_fill"), lambda d: d.write.parquet(daily), log, "daily_load",
                   "feature_engineering", "r1", ["silver_sensor_data"], "gold_daily")
    return spark.read.schema(monitor.RUN_LOG).parquet(log)
