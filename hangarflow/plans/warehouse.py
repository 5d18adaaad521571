"""Sources, sinks, table maintenance and the slowly changing dimension."""

import datetime as dt

from pyspark.sql import functions as F

from hangarflow import bindings as B, rules, schemas
from hangarflow.functions import scalars
from hangarflow.operators import joins, labels, quality
from hangarflow.plans.registry import out, query
from hangarflow.plans.sql_views import S4
from hangarflow.session import staged, work_dir
from hangarflow.sources import files, tables


@query("union_events", out("""
    SELECT maintenance_type, aircraft_id, start_ts, cost_usd FROM (
        SELECT 'corrective' AS maintenance_type, aircraft_id, start_ts, cost_usd FROM maintenance WHERE cost_usd >= 50
        UNION ALL SELECT 'preventive', aircraft_id, start_ts, cost_usd FROM maintenance WHERE cost_usd < 50)""",
    dbl="cost_usd", ts="start_ts", views="maintenance"))
def union_events(spark, sf):
    m = B.maintenance(spark, sf)
    parts = [m.where(F.col("maintenance_type") == k).select("start_ts", "aircraft_id", "cost_usd", "maintenance_type")
             for k in ("corrective", "preventive")]
    return parts[0].unionByName(parts[1])


@query("table_sample", out("SELECT id, aircraft_id, measurement_value FROM readings ORDER BY measurement_value DESC, id LIMIT 10",
                           dbl="measurement_value", views="readings"))
def table_sample(spark, sf):
    return tables.sample(B.readings(spark, sf), 10, ["id", "aircraft_id", "measurement_value"],
                         [F.desc("measurement_value"), F.asc("id")])


@query("param_sql", out("""
    SELECT aircraft_id, count(*) AS readings, max(measurement_value) AS top FROM readings
    WHERE sensor_type = 'pressure' AND measurement_value >= 40.0 GROUP BY 1""", dbl="top", views="readings"))
def param_sql(spark, sf):
    B.readings(spark, sf).createOrReplaceTempView("bronze_sensor_data")
    return tables.sql(spark, """SELECT aircraft_id, count(*) AS readings, max(measurement_value) AS top
        FROM bronze_sensor_data WHERE sensor_type = ? AND measurement_value >= ? GROUP BY aircraft_id""", ["pressure", 40.0])


@query("table_stats", out("""SELECT count(*) AS row_count, min(measurement_timestamp) AS min_date, max(measurement_timestamp) AS max_date
    FROM readings""", ts="min_date max_date", views="readings"))
def table_stats(spark, sf):
    return tables.stats(B.readings(spark, sf), "measurement_timestamp")


@query("ws_text_scan", out("""
    SELECT dataset, engine_id::INTEGER AS engine_id, cycle::INTEGER AS cycle, measurement_value + 1 AS sensor_1, measurement_value + 21 AS sensor_21,
        (life - cycle)::INTEGER AS "RUL", CASE WHEN life - cycle <= 30 THEN 1 ELSE 0 END AS will_fail_30_cycles, CASE WHEN life = cycle THEN 1 ELSE 0 END AS failed
    FROM (SELECT *, 'FD00' || (engine_id % 4 + 1) AS dataset, max(cycle) OVER (PARTITION BY engine_id) AS life FROM engines)""",
    dbl="sensor_1 sensor_21", views="engines"))
def ws_text_scan(spark, sf):
    """Readings written as run-to-failure text, read back over all files, with labels."""
    e = B.engines(spark, sf)
    cells = [F.col("engine_id"), F.col("cycle"), F.col("id") % 3, F.col("id") % 5, F.col("id") % 7]
    cells += [F.col("measurement_value") + i for i in range(1, 22)]
    path = work_dir(spark)
    e.select(F.concat(F.lit(" "), F.concat_ws("  ", *[c.cast("string") for c in cells])).alias("value"),
             F.concat(F.lit("FD00"), (F.col("engine_id") % 4 + 1).cast("string")).alias("source")) \
        .write.partitionBy("source").text(path)
    back = labels.within(labels.rul(files.run_to_failure(spark, path), ["dataset", "engine_id"]))
    return back.select("dataset", "engine_id", "cycle", "sensor_1", "sensor_21", "RUL", "will_fail_30_cycles", "failed")


@query("csv_roundtrip", out("SELECT aircraft_id, date, rpm, temperature FROM daily", dbl="rpm temperature", date="date", views="daily"))
def csv_roundtrip(spark, sf):
    """CSV sink and bulk load with another separator and a column list."""
    path = work_dir(spark)
    daily = B.daily_wide(spark, sf)
    files.write_csv(daily, path, sep=";")
    return files.load_csv(spark, path, daily.schema, ";", ["aircraft_id", "date", "rpm", "temperature"])


@query("format_scan", out("""
    SELECT 'json' AS format, count(*) AS records, sum(l_quantity) AS quantity, count(DISTINCT l_suppkey) AS suppliers FROM lineitem
    UNION ALL SELECT 'orc', count(*), sum(l_quantity), count(DISTINCT l_suppkey) FROM lineitem
    UNION ALL SELECT 'parquet', count(*), sum(l_quantity), count(DISTINCT l_suppkey) FROM lineitem""", dbl="quantity"))
def format_scan(spark, sf):
    """One source in several formats and codecs, picked by name pattern."""
    line = B.table(spark, sf, "lineitem").select("l_suppkey", "l_quantity")
    made = None
    for fmt, codec, pattern in (("json", "gzip", "*.json*"), ("orc", "zlib", "*.orc"), ("parquet", "snappy", "*.parquet")):
        path = work_dir(spark)
        files.write(line, path, fmt, compression=codec)
        one = files.read(spark, path, line.schema, fmt, pattern).agg(
            F.lit(fmt).alias("format"), F.count(F.lit(1)).alias("records"), F.sum("l_quantity").alias("quantity"),
            F.count_distinct("l_suppkey").alias("suppliers"))
        made = one if made is None else made.unionByName(one)
    return made


@query("provenance", out("""
    SELECT DATE '2024-01-31' AS ingestion_day, 'events.parquet' AS source_file, count(*) AS records FROM events""", date="ingestion_day"))
def provenance(spark, sf):
    tagged = files.with_provenance(B.table(spark, sf, "events").select("event_id", "_metadata"), B.AS_OF)
    return tagged.groupBy(F.to_date("ingestion_timestamp").alias("ingestion_day"),
                          F.regexp_extract("source_file", r"([^/]+)$", 1).alias("source_file")).agg(F.count(F.lit(1)).alias("records"))


@query("partitioned_write", out("""
    SELECT year(measurement_timestamp)::INTEGER AS year, month(measurement_timestamp)::INTEGER AS month, day(measurement_timestamp)::INTEGER AS day,
        count(*) AS readings, sum(measurement_value) AS total FROM readings GROUP BY 1, 2, 3""", dbl="total", views="readings"))
def partitioned_write(spark, sf):
    """Date-partitioned write, then a scan of the folders."""
    path = work_dir(spark)
    files.write_by_day(B.readings(spark, sf).drop("raw_data_json"), path, "measurement_timestamp")
    return spark.read.parquet(path).groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("readings"), F.sum("measurement_value").alias("total"))


@query("append_ignore", out("""
    SELECT part_number, reorder_point, unit_cost, CASE WHEN reorder_point <= 25 THEN 'first' ELSE 'second' END AS load
    FROM (SELECT p_partkey AS part_number, p_size AS reorder_point, p_retailprice AS unit_cost FROM part)""", dbl="unit_cost"))
def append_ignore(spark, sf):
    """A second load over a first one: known keys are left alone, repeated ones enter once."""
    p = B.table(spark, sf, "part").select(
        F.col("p_partkey").alias("part_number"), F.col("p_size").alias("reorder_point"), F.col("p_retailprice").alias("unit_cost"))
    path = work_dir(spark)
    tables.append(p.where("reorder_point <= 25").withColumn("load", F.lit("first")), path)
    second = p.withColumn("load", F.lit("second"))
    tables.append(second.unionByName(second), path, "part_number", "ignore", ["unit_cost"])
    return spark.read.schema(second.schema).parquet(path)


@query("upsert", out("""
    SELECT p_partkey AS part_number, p_name AS part_name, p_type AS part_category, coalesce(price, p_retailprice) AS unit_cost
    FROM part LEFT JOIN (SELECT l_partkey, arg_max(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) AS price
        FROM lineitem GROUP BY 1) ON l_partkey = p_partkey""", dbl="unit_cost"))
def upsert(spark, sf):
    """Every sale changes the part's cost; the last one wins and only that column is updated."""
    p = B.table(spark, sf, "part").select(
        F.col("p_type").alias("part_category"), F.col("p_partkey").alias("part_number"), F.col("p_name").alias("part_name"),
        F.col("p_retailprice").alias("unit_cost"))
    path = work_dir(spark)
    p.write.partitionBy("part_category").parquet(path)
    line = B.table(spark, sf, "lineitem")
    kinds = p.select("part_category", F.col("part_number").alias("l_partkey"))
    batch = line.join(kinds, "l_partkey").select(
        "part_category", F.col("l_partkey").alias("part_number"), F.lit("renamed").alias("part_name"),
        F.col("l_extendedprice").alias("unit_cost"), "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey")
    tables.upsert_path(batch, path, ["part_category", "part_number"],
                       ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "unit_cost"],
                       ["unit_cost"], by=["part_category"], schema=p.schema)
    return spark.read.schema(p.schema).parquet(path)


@query("fk_orphans", out("""
    SELECT 'line to order' AS relation, count(*) AS orphans FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'reading to fleet', count(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'fleet to reading', count(*) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)"""))
def fk_orphans(spark, sf):
    line, orders = B.table(spark, sf, "lineitem"), B.table(spark, sf, "orders")
    events, customer = B.table(spark, sf, "events"), B.table(spark, sf, "customer")
    checks = [
        ("line to order", joins.orphans(line, orders, "l_orderkey", "o_orderkey")),
        ("reading to fleet", joins.orphans(events, customer, "user_id", "c_custkey")),
        ("fleet to reading", joins.orphans(customer, events, "c_custkey", "user_id")),
    ]
    made = None
    for name, bad in checks:
        one = bad.agg(F.lit(name).alias("relation"), F.count(F.lit(1)).alias("orphans"))
        made = one if made is None else made.unionByName(one)
    return made


@query("scd2_build", out("SELECT * FROM scd", ts="effective_start_date effective_end_date", views="scd"))
def scd2_build(spark, sf):
    return tables.scd2(B.status_changes(spark, sf), "aircraft_id", "changed_at", "status", "change_id")


@query("scd2_pit", out("""
    SELECT aircraft_id, status, version_number, count(*) AS facts, sum(l_quantity) AS quantity FROM lineitem JOIN scd
    ON aircraft_id = l_suppkey AND l_shipdate >= effective_start_date AND l_shipdate < effective_end_date GROUP BY 1, 2, 3""",
    dbl="quantity", views="scd"))
def scd2_pit(spark, sf):
    versions = staged(tables.scd2(B.status_changes(spark, sf), "aircraft_id", "changed_at", "status", "change_id"))
    facts = B.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("aircraft_id"), F.col("l_shipdate").cast("timestamp").alias("ts"), "l_quantity")
    at = joins.point_in_time(facts, versions, "aircraft_id", "ts", ["status", "version_number"], width=30 * 86400)
    return at.groupBy("aircraft_id", "status", "version_number").agg(
        F.count(F.lit(1)).alias("facts"), F.sum("l_quantity").alias("quantity"))


@query("retention", out("""
    SELECT year(l_shipdate)::INTEGER AS year, count(*) AS kept, min(l_shipdate) AS oldest FROM lineitem
    WHERE l_shipdate >= DATE '2001-12-01' - 730 GROUP BY 1""", ts="oldest"))
def retention(spark, sf):
    line = B.table(spark, sf, "lineitem")
    kept = files.retained(line, "l_shipdate", files.retention_days("bronze.inventory_data"), B.AS_OF_STOCK)
    return kept.groupBy(F.year("l_shipdate").alias("year")).agg(F.count(F.lit(1)).alias("kept"), F.min("l_shipdate").alias("oldest"))


@query("retention_partitions", out("""
    SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS kept FROM lineitem WHERE strftime(l_shipdate, '%Y-%m') >= '1999-12' GROUP BY 1"""))
def retention_partitions(spark, sf):
    """The months before the retention limit go as whole folders of a table partitioned by month; no row is read for that."""
    line = B.table(spark, sf, "lineitem").select("l_orderkey", F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    path = work_dir(spark)
    line.repartition("month").write.partitionBy("month").parquet(path)
    days = files.retention_days("bronze.inventory_data")
    limit = dt.date.fromisoformat(B.AS_OF_STOCK) - dt.timedelta(days=days)
    tables.drop_partitions(spark, path, "month", limit.isoformat()[:7])
    return spark.read.schema(line.schema).parquet(path).groupBy("month").agg(F.count(F.lit(1)).alias("kept"))


@query("storage_tier", out("""
    SELECT CASE WHEN age <= 30 THEN 'hot' WHEN age <= 180 THEN 'warm' ELSE 'cold' END AS tier, count(*) AS records, sum(size)::BIGINT AS bytes
    FROM (SELECT date_diff('day', o_orderdate, DATE '2001-08-10') AS age, strlen(o_orderpriority) + strlen(o_orderstatus) + 32 AS size FROM orders)
    GROUP BY 1"""))
def storage_tier(spark, sf):
    o = B.table(spark, sf, "orders")
    age = F.datediff(F.lit("2001-08-10").cast("date"), F.to_date("o_orderdate"))
    size = F.octet_length("o_orderpriority") + F.octet_length("o_orderstatus") + 32
    return o.groupBy(scalars.storage_tier(age).alias("tier")).agg(F.count(F.lit(1)).alias("records"), F.sum(size).alias("bytes"))
