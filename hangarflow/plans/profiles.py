"""Profiles, distributions, correlations and KPI tables."""

from pyspark.sql import functions as F

from hangarflow import bindings as B, rules
from hangarflow.functions import scalars
from hangarflow.operators import gold, profile
from hangarflow.plans.registry import out, query
from hangarflow.plans.sql_views import S4

NUM = [*S4, "altitude", "ambient_temp", "flight_hours"]


@query("value_dist", out("""
    SELECT will_fail_7days::VARCHAR AS value, count(*) AS records, count(*)::DOUBLE / (SELECT count(*) FROM labeled) AS share
    FROM labeled GROUP BY 1""", dbl="share", views="labeled"))
def value_dist(spark, sf):
    return profile.value_distribution(B.daily_labeled(spark, sf), "will_fail_7days")


@query("failed_entities", out("""
    SELECT count(DISTINCT aircraft_id) FILTER (WHERE failed = 1) AS failed_aircraft, count(DISTINCT aircraft_id) FILTER (WHERE failed = 0) AS operational_aircraft,
        sum(failed)::BIGINT AS failure_days FROM labeled""", views="labeled"))
def failed_entities(spark, sf):
    """Distinct entities by condition: reduced to one row per aircraft first."""
    per = B.daily_labeled(spark, sf).groupBy("aircraft_id").agg(
        F.sum("failed").alias("n"), F.max((F.col("failed") == 0).cast("int")).alias("ok"))
    return per.agg(F.count_if(F.col("n") > 0).alias("failed_aircraft"), F.sum("ok").alias("operational_aircraft"),
                   F.sum("n").alias("failure_days"))


@query("describe", out(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, "
    f"quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75 FROM labeled" for c in NUM),
    dbl="mean std min max p25 p50 p75", views="labeled"))
def describe(spark, sf):
    return profile.describe(B.daily_labeled(spark, sf), NUM)


_pairs = [(a, b) for a in NUM for b in NUM]


@query("corr_matrix", out(" UNION ALL ".join(
    f"SELECT '{a}' AS left_column, '{b}' AS right_column, " + ("max(1.0::DOUBLE)" if a == b else f"corr({a}, {b})") + " AS correlation FROM labeled"
    for a, b in _pairs), dbl="correlation", views="labeled"))
def corr_matrix(spark, sf):
    return profile.correlation_matrix(B.daily_labeled(spark, sf), NUM)


@query("corr_rank", out("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, corr({c}, will_fail_7days) AS correlation, abs(corr({c}, will_fail_7days)) AS strength FROM labeled"
    for c in NUM) + ") ORDER BY strength DESC, column_name LIMIT 5", dbl="correlation strength", views="labeled"))
def corr_rank(spark, sf):
    return profile.correlation_rank(B.daily_labeled(spark, sf), NUM, "will_fail_7days", 5)


@query("histogram", out("""
    SELECT will_fail_7days, bin, count(*) AS records, min(lo + bin * width) AS bin_start FROM (
        SELECT will_fail_7days, lo, width, least(49, floor((temperature - lo) / width))::INTEGER AS bin FROM labeled,
            (SELECT min(temperature) AS lo, (max(temperature) - min(temperature)) / 50 AS width FROM labeled) WHERE temperature IS NOT NULL)
    GROUP BY 1, 2""", dbl="bin_start", views="labeled"))
def histogram(spark, sf):
    return profile.histogram(B.daily_labeled(spark, sf), "temperature", 50, "will_fail_7days")


@query("life_stats", out("""
    SELECT count(*) AS engines, sum(n)::BIGINT AS records, min(life) AS min_life, max(life) AS max_life, avg(life) AS avg_life, stddev_samp(life) AS std_life
    FROM (SELECT engine_id, max(cycle) AS life, count(*) AS n FROM engines GROUP BY 1)""", dbl="avg_life std_life", views="engines"))
def life_stats(spark, sf):
    return profile.life_stats(B.engines(spark, sf))


@query("dataset_compare", out("""
    SELECT dataset, count(*) AS records, count(DISTINCT engine_id) AS engines, sum(CASE WHEN cycle = life THEN life END)::DOUBLE / count(DISTINCT engine_id) AS avg_cycles,
        100.0::DOUBLE * sum(CASE WHEN life - cycle <= 30 THEN 1 ELSE 0 END) / count(*) AS failure_rate
    FROM (SELECT *, 'FD00' || (engine_id % 4 + 1) AS dataset, max(cycle) OVER (PARTITION BY engine_id) AS life FROM engines) GROUP BY 1""",
    dbl="avg_cycles failure_rate", views="engines"))
def dataset_compare(spark, sf):
    tagged = B.engines(spark, sf).withColumn("dataset", F.concat(F.lit("FD00"), (F.col("engine_id") % 4 + 1).cast("string")))
    return profile.dataset_compare(tagged)


@query("cost_analysis", out("""
    SELECT maintenance_type, count(*) AS events, sum(cost_usd) AS total_cost, avg(cost_usd) AS avg_cost,
        100 * sum(cost_usd) / (SELECT sum(cost_usd) FROM maintenance) AS cost_share_pct FROM maintenance GROUP BY 1""",
    dbl="total_cost avg_cost cost_share_pct", views="maintenance"))
def cost_analysis(spark, sf):
    return profile.cost_analysis(B.maintenance(spark, sf))


@query("stock_summary", out("""
    SELECT part_number, avg(quantity_on_hand) AS avg_stock, min(reorder_point) AS reorder_point,
        count(*) FILTER (WHERE quantity_on_hand < reorder_point) AS stock_outs, count(*) AS snapshots FROM inventory GROUP BY 1""",
    dbl="avg_stock", views="inventory"))
def stock_summary(spark, sf):
    return profile.stock_summary(B.inventory(spark, sf))


@query("fleet_profile", out("""
    SELECT model, location, count(*) AS aircraft, avg(2023 - manufacture_year) AS avg_age, min(2023 - manufacture_year) AS min_age,
        max(2023 - manufacture_year) AS max_age FROM fleet GROUP BY 1, 2""", dbl="avg_age", views="fleet"))
def fleet_profile(spark, sf):
    return profile.fleet_profile(B.fleet(spark, sf), 2023)


@query("fleet_join", out("""
    SELECT model, sensor_type, count(*) AS readings, avg(measurement_value) AS avg_value, avg(total_flight_hours) AS avg_cumulative_hours,
        avg((2024 - manufacture_year) * measurement_value) AS age_value_interaction
    FROM readings JOIN fleet USING (aircraft_id) GROUP BY 1, 2""", dbl="avg_value avg_cumulative_hours age_value_interaction", views="readings fleet"))
def fleet_join(spark, sf):
    """Readings with fleet data. Sums per aircraft come first, so the join sees one row per aircraft and type."""
    per = B.readings(spark, sf).groupBy("aircraft_id", "sensor_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("measurement_value").alias("s"))
    age = 2024 - F.col("manufacture_year")
    return per.join(B.fleet(spark, sf), "aircraft_id").groupBy("model", "sensor_type").agg(
        F.sum("n").alias("readings"), (F.sum("s") / F.sum("n")).alias("avg_value"),
        (F.sum(F.col("total_flight_hours") * F.col("n")) / F.sum("n")).alias("avg_cumulative_hours"),
        (F.sum(age * F.col("s")) / F.sum("n")).alias("age_value_interaction"))


def _win_sql(label, bucket):
    return (f"SELECT aircraft_id, sensor_type, {bucket} AS window_start, '{label}' AS \"window\", avg(measurement_value) AS mean, stddev_samp(measurement_value) AS std, "
            "min(measurement_value) AS min, max(measurement_value) AS max, median(measurement_value) AS median, quantile_cont(measurement_value, 0.25) AS percentile_25, "
            "quantile_cont(measurement_value, 0.75) AS percentile_75 FROM readings GROUP BY 1, 2, 3")


@query("window_stats", out(" UNION ALL ".join(
    _win_sql(w, f"time_bucket(INTERVAL '{w}', measurement_timestamp, TIMESTAMP '1970-01-01')") for w in rules.AGG_WINDOWS),
    dbl="mean std min max median percentile_25 percentile_75", ts="window_start", views="readings"))
def window_stats(spark, sf):
    """Six tumbling windows."""
    r = B.readings(spark, sf)
    made = None
    for w in rules.AGG_WINDOWS:
        one = profile.window_stats(r, w)
        made = one if made is None else made.unionByName(one)
    return made


@query("daily_summary", out("""
    SELECT aircraft_id, sensor_type, measurement_timestamp::DATE AS date, min(measurement_value) AS min, max(measurement_value) AS max,
        avg(measurement_value) AS avg, stddev_samp(measurement_value) AS std FROM readings GROUP BY ALL""",
    dbl="min max avg std", date="date", views="readings"))
def daily_summary(spark, sf):
    return profile.daily_summary(B.readings(spark, sf))


@query("maint_kpis", out("""
    SELECT aircraft_id, coalesce(n, 0) AS failures, mtbf_days, mttr_hours, coalesce(n, 0) / 30.0::DOUBLE AS failure_rate
    FROM (SELECT aircraft_id, avg(downtime_hours) FILTER (WHERE maintenance_type = 'corrective') AS mttr_hours FROM maintenance GROUP BY 1) m
    FULL JOIN (SELECT aircraft_id, count(*) AS n, avg(date_diff('microsecond', before, failure_ts) / 86400000000.0::DOUBLE) AS mtbf_days
        FROM (SELECT *, lag(failure_ts) OVER (PARTITION BY aircraft_id ORDER BY failure_ts) AS before FROM failures) GROUP BY 1) f USING (aircraft_id)""",
    dbl="mtbf_days mttr_hours failure_rate", views="maintenance failures"))
def maint_kpis(spark, sf):
    return profile.maintenance_kpis(B.failures(spark, sf), B.maintenance(spark, sf), 30)


@query("inv_kpis", out("""
    SELECT part_number, avg(quantity_on_hand) AS avg_level, -sum(CASE WHEN d < 0 THEN d END) / avg(quantity_on_hand) AS turnover,
        count(*) FILTER (WHERE quantity_on_hand < reorder_point) AS stockout_incidents
    FROM (SELECT *, quantity_on_hand - lag(quantity_on_hand) OVER (PARTITION BY part_number ORDER BY snapshot_date) AS d FROM inventory) GROUP BY 1""",
    dbl="avg_level turnover", views="inventory"))
def inv_kpis(spark, sf):
    return profile.inventory_kpis(B.inventory(spark, sf))


_STATUS = """CASE WHEN quantity_available <= 0 THEN 'out_of_stock' WHEN quantity_available <= reorder_point THEN 'low_stock'
    WHEN quantity_available > reorder_point * 3 THEN 'overstock' ELSE 'in_stock' END"""


@query("stock_status", out(f"SELECT {_STATUS} AS stock_status, count(*) AS snapshots, sum(quantity_available)::BIGINT AS available FROM inventory GROUP BY 1", views="inventory"))
def stock_status(spark, sf):
    """The warehouse function used from SQL text."""
    scalars.register_sql(spark)
    return spark.sql(
        "SELECT calculate_stock_status(quantity_available, reorder_point) AS stock_status, count(*) AS snapshots, "
        "sum(quantity_available) AS available FROM {inv} GROUP BY 1", inv=B.inventory(spark, sf))


_RISK = "CASE WHEN {p} >= 0.75 THEN 'critical' WHEN {p} >= 0.5 THEN 'high' WHEN {p} >= 0.25 THEN 'medium' ELSE 'low' END"


@query("risk_level", out(f"""SELECT {_RISK.format(p='failure_probability')} AS risk_level, count(*) AS predictions, max(failure_probability) AS top_probability
    FROM scored GROUP BY 1""", dbl="top_probability", views="scored"))
def risk_level(spark, sf):
    return B.scored(spark, sf).groupBy(scalars.risk_level(F.col("failure_probability")).alias("risk_level")).agg(
        F.count(F.lit(1)).alias("predictions"), F.max("failure_probability").alias("top_probability"))


@query("risk_share", out(f"""SELECT {_RISK.format(p='p')} AS risk_level, count(*) AS records, count(*)::DOUBLE / (SELECT count(DISTINCT aircraft_id) FROM scored) AS share
    FROM (SELECT aircraft_id, max(failure_probability) AS p FROM scored GROUP BY 1) GROUP BY 1""", dbl="share", views="scored"))
def risk_share(spark, sf):
    return profile.risk_share(B.scored(spark, sf))


@query("availability", out("""
    SELECT part_category, avg((quantity_available > 0)::INTEGER) AS parts_available_share, avg((quantity_available > 0)::INTEGER) >= 0.5 AS parts_available
    FROM latest_stock GROUP BY 1""", dbl="parts_available_share", views="latest_stock"))
def availability(spark, sf):
    return gold.availability(gold.latest_stock(B.inventory(spark, sf)))
