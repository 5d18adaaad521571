"""From scores to predictions, alerts, stock recommendations and KPIs."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from hangarflow import rules
from hangarflow.functions import scalars
from hangarflow.operators import joins


def contributions(readings: DataFrame, by="aircraft_id", ts="measurement_timestamp", value="measurement_value", top: int = 3) -> DataFrame:
    """Top sensor types per aircraft-day by share (percent) of the summed signal, as JSON."""
    per = readings.groupBy(by, F.to_date(ts).alias("prediction_date"), "sensor_type").agg(F.sum(value).alias("v"))
    day = Window.partitionBy(by, "prediction_date")  # at most one row per sensor type
    signal = per.withColumn("_all", F.sum("v").over(day))
    # Of a day whose signal sums to 0 a share is NaN or infinite, as in the SQL answer; NaN ranks first.
    none = F.when(F.col("v") > 0, F.lit(math.inf)).when(F.col("v") < 0, F.lit(-math.inf)).when(F.col("v").isNotNull(), F.lit(math.nan))
    part = F.when(F.col("_all") == 0, none).otherwise(F.try_divide(100 * F.col("v"), F.col("_all")))
    ranked = signal.select(
        by, "prediction_date", "sensor_type", F.round(part + 1e-9, 2).alias("share")
    ).withColumn("_r", F.row_number().over(day.orderBy(F.desc("share"), "sensor_type"))).where(F.col("_r") <= top)
    item = F.struct(F.col("_r"), F.col("sensor_type").alias("sensor"), F.col("share").alias("contribution"))
    listed = ranked.groupBy(by, "prediction_date").agg(F.sort_array(F.collect_list(item)).alias("l"))
    text = F.to_json(F.transform("l", lambda x: F.struct(x.sensor.alias("sensor"), x.contribution.alias("contribution"))))
    return listed.select(
        by, "prediction_date", F.col("l")[0]["sensor"].alias("most_likely_component"),
        F.regexp_replace(text, '"contribution":"(NaN|-?Infinity)"', '"contribution":$1').alias("contributing_sensors_json"),
    )


def predictions(scored: DataFrame, contributing: DataFrame | None = None, model_id="baseline", model_version="1.0",
                p="failure_probability", by="aircraft_id", day="prediction_date", cut=0.5, horizon=rules.HORIZON_DAYS) -> DataFrame:
    out = scored.select(
        by, day, p, (F.col(p) >= cut).alias("failure_prediction"), scalars.risk_level(F.col(p)).alias("risk_level"),
        F.col(day).alias("predicted_failure_window_start"), F.date_add(day, horizon).alias("predicted_failure_window_end"),
        F.lit(model_id).alias("model_id"), F.lit(model_version).alias("model_version"),
        F.greatest(F.col(p), 1 - F.col(p)).alias("prediction_confidence"),
        scalars.business_key(by, day).alias("feature_snapshot_id"),
    )
    return out.join(contributing, [by, day], "left") if contributing is not None else out


def predictive_alerts(preds: DataFrame, p="failure_probability", by="aircraft_id", day="prediction_date") -> DataFrame:
    """The highest rule each prediction meets; below all rules there is no alert."""
    q = F.col(p)
    rule = scalars.alert_field(q, 0)
    return preds.where(q >= rules.ALERT_RULES[-1][1]).select(
        scalars.business_key(by, day, rule).alias("alert_id"), by, F.col(day).cast("timestamp").alias("alert_timestamp"),
        F.lit("predictive_failure").alias("alert_type"), rule.alias("rule"), scalars.alert_field(q, 2).alias("severity"),
        F.lit("open").alias("status"), q.alias("failure_probability"), scalars.alert_field(q, 3).alias("recommended_action"),
        scalars.alert_field(q, 4).alias("recommended_timeframe"), scalars.alert_field(q, 5).alias("dashboard_priority"),
    )


def threshold_alerts(readings: DataFrame, table=None, by="aircraft_id", ts="measurement_timestamp",
                     value="measurement_value", kind="sensor_type") -> DataFrame:
    """One alert per reading and broken rule; stateless, so it also runs on streams."""
    fired = F.filter(
        F.array(*[
            F.when((F.col(kind) == k) & (F.col(value) >= limit),
                   F.struct(F.lit(name).alias("rule"), F.lit(limit).alias("threshold"), F.lit(sev).alias("severity")))
            for name, k, limit, sev in (table or rules.THRESHOLD_RULES)
        ]), lambda r: r.isNotNull())
    return readings.select("id", by, ts, kind, value, F.explode(fired).alias("r")).select(
        scalars.business_key(F.col("id"), F.col("r.rule")).alias("alert_id"), by, F.col(ts).alias("alert_timestamp"),
        F.lit("threshold_exceeded").alias("alert_type"), "r.rule", "r.severity", F.lit("open").alias("status"),
        F.col(value).alias("observed"), "r.threshold",
    )


def _due(preds: DataFrame, as_of: str, p="failure_probability", day="prediction_date", cut=0.5) -> DataFrame:
    today = F.lit(as_of).cast("date")
    return preds.where((F.col(day) > F.date_sub(today, rules.HORIZON_DAYS)) & (F.col(day) <= today) & (F.col(p) >= cut))


def related_aircraft(preds: DataFrame, as_of: str, slot: str, by="aircraft_id") -> DataFrame:
    """One row per slot and aircraft that is due: how many predictions say so."""
    return _due(preds, as_of).groupBy(slot, by).agg(F.count(F.lit(1)).alias("predictions"))


def aircraft_lists(related: DataFrame, slot: str, by="aircraft_id") -> DataFrame:
    """The aircraft of each slot, sorted, as one text; a slot's part of the fleet bounds it."""
    return related.groupBy(slot).agg(
        F.count(F.lit(1)).alias("aircraft"),
        F.concat_ws(",", F.transform(F.sort_array(F.collect_set(by)), lambda a: a.cast("string"))).alias("related_aircraft_list"))


def recommend(preds: DataFrame, stock: DataFrame, as_of: str, downtime_saving, slot: str,
              p="failure_probability", day="prediction_date", cut=0.5) -> DataFrame:
    """Order, expedite, reduce or leave each part, from predicted demand and its latest snapshot.

    ``slot`` is the column (in both frames) that links aircraft and parts.
    Predictions are reduced per slot before they meet the parts. Which aircraft a
    recommendation is about is the same for all parts of a slot, so it is a table of
    its own, by slot (:func:`related_aircraft`), not a list repeated for each part.
    ``downtime_saving`` is the mean corrective minus the mean preventive cost.
    """
    today = F.lit(as_of).cast("date")
    demand = _due(preds, as_of, p, day, cut).groupBy(slot).agg(F.count(F.lit(1)).cast("int").alias("predicted_demand_7d"))
    d7 = F.coalesce(F.col("predicted_demand_7d"), F.lit(0))
    base = stock.join(demand, slot, "left").select(
        "part_number", "part_name", F.col("quantity_on_hand").alias("current_quantity"),
        F.col("quantity_reserved").alias("current_reserved"), F.col("quantity_available").alias("current_available"),
        "reorder_point", "unit_cost", d7.alias("predicted_demand_7d"),
        F.round(d7 * 30 / 7).cast("int").alias("predicted_demand_30d"), d7.alias("related_predictions_count"),
        F.col(slot).alias("slot"),
    )
    have, d30, point = F.col("current_available"), F.col("predicted_demand_30d"), F.col("reorder_point")
    status = scalars.stock_status(have, point)
    kind = (
        F.when(have < F.col("predicted_demand_7d"), "expedite").when(have - d30 < point, "order")
        .when((status == "overstock") & (d30 == 0), "reduce").otherwise("no_action")
    )
    typed = base.withColumn("recommendation_type", kind)
    t = F.col("recommendation_type")
    quantity = F.greatest(F.lit(0), d30 + point - have)
    return typed.select(
        today.alias("recommendation_date"), "part_number", "part_name", "current_quantity", "current_reserved",
        "current_available", "predicted_demand_7d", "predicted_demand_30d", "recommendation_type",
        quantity.alias("recommended_order_quantity"),
        F.when((t == "expedite") | (have <= 0), "urgent").when(have <= point, "high").when(t == "order", "normal")
        .otherwise("low").alias("recommended_priority"),
        "related_predictions_count", "slot",
        F.when(d30 > 0, F.date_add(today, F.floor(have * 30 / d30).cast("int"))).alias("expected_stockout_date"),
        (quantity * F.col("unit_cost")).alias("estimated_cost"),
        (F.col("predicted_demand_7d") * downtime_saving).alias("potential_downtime_cost_avoided"),
    )


def cost_gap(maintenance: DataFrame):
    """Mean corrective minus mean preventive cost, as a scalar column."""
    def mean(kind):
        return F.avg(F.when(F.col("maintenance_type") == kind, F.col("cost_usd")))

    return maintenance.agg((mean("corrective") - mean("preventive")).alias("gap")).scalar()


def kpi(dim: DataFrame, alerts: DataFrame, preds: DataFrame, recs: DataFrame, as_of: str, by="aircraft_id") -> DataFrame:
    """The one-row daily KPI summary.

    The published view joins alerts, predictions and keyless recommendations, so
    every aircraft fans out and its average is weighted by alerts. Here each side
    is reduced per aircraft, the weight is carried along, and recommendations,
    which only multiply all rows alike, are counted on their own. Alerts are counted
    by their id: a repeated one counts once, though it still weighs on the average.
    """
    today = F.lit(as_of).cast("date")
    fleet = dim.where("is_current").groupBy(by).agg(
        F.max((F.col("operational_status") == "active").cast("int")).alias("active"), F.count(F.lit(1)).alias("rows"))
    start = today.cast("timestamp")
    a = alerts.where((F.col("alert_timestamp") >= start) & (F.col("alert_timestamp") < start + F.expr("INTERVAL 1 DAY")))
    is_open = F.col("status") == "open"
    flags = a.join(fleet.select(by), by, "left_semi").groupBy("alert_id").agg(
        F.max(((F.col("severity") == "critical") & is_open).cast("int")).alias("critical"),
        F.max(((F.col("severity") == "high") & is_open).cast("int")).alias("high"))
    counted = flags.where("alert_id IS NOT NULL").agg(F.struct(
        F.count(F.lit(1)).alias("alerts"), F.coalesce(F.sum("critical"), F.lit(0)).alias("critical"), F.coalesce(F.sum("high"), F.lit(0)).alias("high")).alias("c")).scalar()
    a = a.groupBy(by).agg(F.count(F.lit(1)).alias("alerts"))
    p = preds.where(F.col("prediction_date") == today).groupBy(by).agg(
        F.count("failure_probability").alias("n"), F.sum("failure_probability").alias("s"),
        F.max((F.col("risk_level") == "critical").cast("int")).alias("risk_critical"),
        F.max((F.col("risk_level") == "high").cast("int")).alias("risk_high"))
    joined = fleet.join(a, by, "left").join(p, by, "left")
    weight = F.greatest(F.coalesce("alerts", F.lit(0)), F.lit(1)) * F.col("rows")

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0))

    urgent = recs.where(
        (F.col("recommendation_date") == today) & (F.col("recommendation_type") == "order") & (F.col("recommended_priority") == "urgent"))
    # One row per part already; counting distinct parts keeps dirty input right.
    urgent = urgent.select("part_number").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    return joined.agg(
        F.count(F.lit(1)).alias("total_aircraft"), total("active").alias("active_aircraft"),
        scalars.divide(F.sum(weight * F.col("s")), F.sum(weight * F.col("n"))).alias("avg_failure_probability"),
        total("risk_critical").alias("aircraft_critical_risk"), total("risk_high").alias("aircraft_high_risk"),
    ).withColumn("_c", counted).select(
        today.alias("kpi_date"), "total_aircraft", "active_aircraft", F.col("_c.critical").alias("critical_alerts_open"),
        F.col("_c.high").alias("high_alerts_open"), F.col("_c.alerts").alias("total_alerts_today"), "avg_failure_probability",
        "aircraft_critical_risk", "aircraft_high_risk",
        F.when(F.col("total_aircraft") > 0, urgent).otherwise(F.lit(0)).alias("urgent_part_orders"),
    )


def feedback(preds: DataFrame, failures: DataFrame, by="aircraft_id", day="prediction_date", pred="prediction",
             horizon=rules.HORIZON_DAYS) -> DataFrame:
    """Compare each prediction with the failures inside its window."""
    days = failures.select(by, F.to_date("failure_ts").alias("_f")).distinct()
    hit = joins.asof(preds, days, by, day, "_f", ["_f"], forward=True, width=None)
    actual = F.coalesce(F.datediff("_f", day) <= horizon, F.lit(False))
    said = F.col(pred) == 1
    return hit.select(*preds.columns, actual.alias("actual_failure_occurred"),
                      F.when(said & actual, "true_positive").when(said, "false_positive")
                      .when(actual, "false_negative").otherwise("true_negative").alias("prediction_accuracy"))


def error_cost(judged: DataFrame, maintenance: DataFrame, by="aircraft_id") -> DataFrame:
    """Misses cost a mean corrective job, false alarms a mean preventive one."""
    def mean(kind):
        return F.avg(F.when(F.col("maintenance_type") == kind, F.col("cost_usd"))).alias(kind)

    costs = maintenance.agg(F.struct(mean("corrective"), mean("preventive")).alias("c")).scalar()
    per = judged.groupBy(by).agg(
        F.count_if(F.col("prediction_accuracy") == "false_negative").alias("misses"),
        F.count_if(F.col("prediction_accuracy") == "false_positive").alias("false_alarms"),
        F.avg(F.when(F.col("prediction_accuracy").isin("false_negative", "false_positive"), F.col("failure_probability"))).alias("mean_wrong_score"),
    ).withColumn("_c", costs)
    return per.select(by, "misses", "false_alarms", "mean_wrong_score",
                      (F.col("misses") * F.col("_c.corrective") + F.col("false_alarms") * F.col("_c.preventive")).alias("cost"))


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-free identity of a data set: row count, XOR and sum of row hashes.

    The sum (on 32-bit halves, which cannot overflow) keeps pairs of equal rows visible.
    """
    h = F.xxhash64(*df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(h).alias("hash_xor"),
                  F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("hash_low"), F.sum(F.shiftrightunsigned(h, 32)).alias("hash_high"))
