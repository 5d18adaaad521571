"""The engine's datasets expressed over the given test tables.

Each function reads only the columns it needs; Spark pushes the projection and
filters into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hangarflow import rules
from hangarflow.operators import ordered
from hangarflow.session import configure

AS_OF = "2024-01-31"
AS_OF_STOCK = "2001-12-01"
# Which event type stands in for which sensor; "error" carries the failures.
SENSOR_OF_TYPE = {"click": "temperature", "view": "vibration", "signup": "pressure", "purchase": "rpm"}
PARTS_OF_MODEL = {"AUTOMOBILE": "ECONOMY", "BUILDING": "LARGE", "FURNITURE": "MEDIUM", "HOUSEHOLD": "SMALL",
                  "MACHINERY": "STANDARD"}
SLOTS = 40  # an aircraft and a part belong together when their ids share a slot
FAILURE_VALUE = 100
CORRECTIVE_VALUE = 50
TEST_RANGES = {
    "temperature": (5.0, 150.0), "vibration": (1.0, 80.0), "pressure": (0.0, 100.0), "rpm": (10.0, 200.0),
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def sensor_type(event_type: Column) -> Column:
    out = None
    for source, sensor in SENSOR_OF_TYPE.items():
        out = F.when(event_type == source, sensor) if out is None else out.when(event_type == source, sensor)
    return out.otherwise(event_type)


def readings(spark, sf) -> DataFrame:
    """Long shape: one row per reading."""
    e = table(spark, sf, "events")
    kind = sensor_type(F.col("event_type"))
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("aircraft_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), kind).alias("sensor_id"),
        kind.alias("sensor_type"),
        F.col("ts").cast("timestamp").alias("measurement_timestamp"),
        F.col("value").alias("measurement_value"),
        F.col("props").alias("raw_data_json"),
    )


def daily_wide(spark, sf) -> DataFrame:
    """Wide shape: one row per aircraft and day, about 60 % of sensor cells empty."""
    r = readings(spark, sf)
    return r.groupBy("aircraft_id", F.to_date("measurement_timestamp").alias("date")).agg(*[
        F.avg(F.when(F.col("sensor_type") == s, F.col("measurement_value"))).alias(s) for s in rules.SENSORS
    ])


def failures(spark, sf) -> DataFrame:
    r = readings(spark, sf).where((F.col("sensor_type") == "error") & (F.col("measurement_value") >= FAILURE_VALUE))
    return r.select("id", "aircraft_id", F.col("measurement_timestamp").alias("failure_ts"),
                    F.col("measurement_value").alias("magnitude"))


def daily_labeled(spark, sf) -> DataFrame:
    """The 13-column daily file: sensors, surroundings, cycle and labels."""
    r = readings(spark, sf)
    value = F.col("measurement_value")
    failed = (F.col("sensor_type") == "error") & (value >= FAILURE_VALUE)
    daily = r.groupBy("aircraft_id", F.to_date("measurement_timestamp").alias("date")).agg(
        *[F.avg(F.when(F.col("sensor_type") == s, value)).alias(s) for s in rules.SENSORS],
        F.avg(F.when(F.col("sensor_type") == "error", value)).alias("altitude"),
        F.avg(value).alias("ambient_temp"),
        F.count(F.lit(1)).cast("double").alias("flight_hours"),
        F.max(failed.cast("int")).alias("failed"),
    )
    return _with_labels(daily)


def history(spark, sf) -> DataFrame:
    """The 13-column daily file once more, over seven years: suppliers stand in for aircraft, their lines for readings."""
    line = table(spark, sf, "lineitem")
    failed = (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 45)
    daily = line.groupBy(F.col("l_suppkey").alias("aircraft_id"), F.to_date("l_shipdate").alias("date")).agg(
        F.avg("l_quantity").alias("temperature"), F.avg(F.col("l_discount") * 100).alias("vibration"),
        F.avg(F.col("l_extendedprice") / 1000).alias("pressure"), F.avg(F.col("l_tax") * 100).alias("rpm"),
        F.max("l_extendedprice").alias("altitude"), F.min("l_quantity").alias("ambient_temp"),
        F.count(F.lit(1)).cast("double").alias("flight_hours"), F.max(failed.cast("int")).alias("failed"),
    )
    return _with_labels(daily)


def _with_labels(daily: DataFrame) -> DataFrame:
    """Cycle, days to the next failure and the label."""
    numbered = ordered.row_index(daily, "aircraft_id", "date", "cycle", start=0)
    labeled = ordered.nearest_seen(
        numbered, "aircraft_id", "date", {"_next": (F.col("date"), F.col("failed") == 1)}, forward=True
    )
    gap = F.datediff("_next", "date")
    return labeled.select(
        "aircraft_id", "date", F.col("cycle").cast("int").alias("cycle"), *rules.SENSORS, "altitude",
        "ambient_temp", "flight_hours", "failed", gap.alias("days_to_failure"),
        F.coalesce((gap <= rules.HORIZON_DAYS).cast("int"), F.lit(0)).alias("will_fail_7days"),
    )


def maintenance(spark, sf) -> DataFrame:
    r = readings(spark, sf).where(F.col("sensor_type") == "rpm")
    value = F.col("measurement_value")
    return r.select(
        "id", "aircraft_id",
        F.col("measurement_timestamp").alias("start_ts"),
        F.when(value >= CORRECTIVE_VALUE, "corrective").otherwise("preventive").alias("maintenance_type"),
        value.alias("downtime_hours"), value.alias("cost_usd"),
        F.get_json_object("raw_data_json", "$.k").cast("int").alias("labor_hours"),
    )


def inventory(spark, sf) -> DataFrame:
    """One row per part and snapshot day; lines are summed before the part join."""
    line = table(spark, sf, "lineitem")
    qty = F.col("l_quantity").cast("int")
    snap = line.groupBy("l_partkey", F.to_date("l_shipdate").alias("snapshot_date")).agg(
        F.sum(qty).cast("int").alias("quantity_on_hand"),
        F.coalesce(F.sum(F.when(F.col("l_linestatus") == "O", qty)), F.lit(0)).cast("int").alias("quantity_reserved"),
        F.min("l_suppkey").alias("supplier_id"),
    )
    part = table(spark, sf, "part")
    return snap.join(part, snap.l_partkey == part.p_partkey).select(
        F.col("p_partkey").alias("part_number"), F.col("p_name").alias("part_name"),
        F.col("p_type").alias("part_category"), "snapshot_date", "quantity_on_hand", "quantity_reserved",
        (F.col("quantity_on_hand") - F.col("quantity_reserved")).alias("quantity_available"),
        F.col("p_size").alias("reorder_point"), F.col("p_retailprice").alias("unit_cost"), "supplier_id",
        (F.col("p_size") % 15 + 7).alias("lead_time_days"),
    )


def fleet(spark, sf) -> DataFrame:
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("aircraft_id"), F.col("c_mktsegment").alias("model"),
        (F.col("c_nationkey") + 1990).alias("manufacture_year"),
        F.col("c_acctbal").alias("total_flight_hours"), F.col("n_name").alias("location"),
    )


def part_kind(model: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in PARTS_OF_MODEL.items() for x in kv])[model]


def status_changes(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("aircraft_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("changed_at"), F.col("o_orderkey").alias("change_id"),
    )


def scored(spark, sf) -> DataFrame:
    """A stand-in failure score per aircraft-day with the true outcome."""
    r = readings(spark, sf)
    value = F.col("measurement_value")
    failed = (F.col("sensor_type") == "error") & (value >= FAILURE_VALUE)
    daily = r.groupBy("aircraft_id", F.to_date("measurement_timestamp").alias("prediction_date")).agg(
        F.round(F.least(F.lit(1.0), F.avg(value) / 200) + 1e-9, 4).alias("failure_probability"),
        F.max(failed.cast("int")).alias("_failed"),
    )
    labeled = ordered.nearest_seen(
        daily, "aircraft_id", "prediction_date",
        {"_next": (F.col("prediction_date"), F.col("_failed") == 1)}, forward=True,
    )
    within = F.datediff("_next", "prediction_date") <= rules.HORIZON_DAYS
    return labeled.select(
        "aircraft_id", "prediction_date", "failure_probability",
        F.coalesce(within.cast("int"), F.lit(0)).alias("label"),
        (F.col("failure_probability") >= 0.25).cast("int").alias("prediction"),
    )


def engines(spark, sf) -> DataFrame:
    """Run-to-failure shape: cycle is the position of the reading in its series."""
    r = readings(spark, sf).select(
        F.col("aircraft_id").alias("engine_id"), "id", "measurement_timestamp", "sensor_type", "measurement_value"
    )
    return ordered.row_index(r, "engine_id", "measurement_timestamp", "cycle", order=["id"], width=ordered.DAY)


def raw_text(spark, sf) -> DataFrame:
    """Readings as a careless source would send them: mixed formats and units."""
    e = table(spark, sf, "events")
    kind, third = sensor_type(F.col("event_type")), F.col("event_id") % 3
    ts = F.col("ts").cast("timestamp")
    shown = (
        F.when(F.col("event_id") % 97 == 0, "not a time")
        .when(third == 0, F.date_format(ts, rules.TIMESTAMP_FORMATS[0]))
        .when(third == 1, F.date_format(ts, rules.TIMESTAMP_FORMATS[1]))
        .otherwise(F.date_format(ts, rules.TIMESTAMP_FORMATS[2]))
    )
    unit = (
        F.when(kind == "temperature", F.element_at(F.array(*map(F.lit, ["fahrenheit", "celsius", "kelvin"])), (third + 1).cast("int")))
        .when(kind == "pressure", F.element_at(F.array(*map(F.lit, ["psi", "bar", "pascal"])), (third + 1).cast("int")))
    )
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("aircraft_id"),
        F.concat(F.lit("  ac_"), F.col("user_id").cast("string"), F.lit(". "), kind).alias("sensor_id"),
        kind.alias("sensor_type"),
        shown.alias("measurement_timestamp"),
        F.when(F.col("event_id") % 89 == 0, "n/a")
        .otherwise(F.col("value").cast("string")).alias("measurement_value"),
        unit.alias("measurement_unit"),
    )


def gappy_readings(spark, sf) -> DataFrame:
    """Readings where the value is missing whenever the payload says so (k < 20)."""
    r = readings(spark, sf)
    k = F.get_json_object("raw_data_json", "$.k").cast("int")
    return r.withColumn("measurement_value", F.when(k >= 20, F.col("measurement_value"))).drop("raw_data_json")


def parts_used(spark, sf) -> DataFrame:
    """Per order a JSON array of up to three (part, qty), made from the order's own columns."""
    n = (F.col("o_orderkey") % 4).cast("int")
    item = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        (F.col("o_custkey") + i).alias("part"), (i * 1.0).alias("qty")))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.when(n > 0, F.to_json(item)).alias("parts_used_json"))


def taxonomy(spark, sf) -> DataFrame:
    """Category -> component type, derived from the parts; PROMO and SMALL are left unmapped."""
    p = table(spark, sf, "part").where(~F.col("p_type").isin("PROMO", "SMALL"))
    return p.groupBy(F.col("p_type").alias("part_category")).agg(
        F.concat(F.lit("component-"), F.lower(F.first("p_type"))).alias("component_type")
    )
