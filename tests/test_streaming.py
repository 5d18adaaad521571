"""Streams: late rows, restart, state over several batches, upsert per batch."""

import datetime as dt

from pyspark.sql import functions as F

from hangarflow.session import work_dir
from hangarflow.streaming import streams

SCHEMA = "id long, aircraft_id long, sensor_id string, sensor_type string, measurement_timestamp timestamp, measurement_value double"
T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def row(i, hours, value=1.0, sensor="s"):
    return (i, 1, sensor, "temperature", at(hours), value)


def feed(spark, batches):
    """One file per batch, read one file at a time in order."""
    import time

    folder = work_dir(spark)
    for b in batches:
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)  # file sources go by modification time
    return folder, streams.read(spark, folder, spark.createDataFrame([], SCHEMA).schema, "*.parquet", files_per_batch=1)


def test_late_rows(spark):
    # The watermark reaches hour 9 with the first file and counts for late rows one batch later:
    # then the window of hour 0 is closed, the one of hour 9 still open.
    _, stream = feed(spark, [[row(1, 0.5), row(2, 10)], [row(7, 10.2)], [row(3, 0.6), row(4, 9.5), row(5, 30)], [row(6, 31)]])
    got = {r.window_start: r.readings for r in streams.drain_append(streams.windowed(stream, "1 hour")).collect()}
    assert got[at(0)] == 1  # row 3 came too late
    assert got[at(9)] == 1 and got[at(10)] == 2
    assert at(31) not in got  # still open


def test_restart_adds_nothing_twice(spark):
    folder, stream = feed(spark, [[row(1, 0), row(2, 1), row(1, 0)]])
    path, mark = work_dir(spark), work_dir(spark)
    keys = ["aircraft_id", "sensor_id", "measurement_timestamp"]
    assert streams.drain_append(streams.dedup(stream, keys), path=path, checkpoint=mark).count() == 2
    spark.createDataFrame([row(2, 1), row(3, 2)], SCHEMA).write.mode("append").parquet(folder)
    again = streams.read(spark, folder, stream.schema, "*.parquet")
    assert sorted(r.id for r in streams.drain_append(streams.dedup(again, keys), path=path, checkpoint=mark).collect()) == [1, 2, 3]


def test_state_streak_and_silence(spark):
    first = [row(1, 0, 9.0), row(2, 2, 9.0), row(3, 1, 0.0), row(4, 0, 5.0, "quiet")]
    second = [row(5, 3, 9.0), row(6, 4, 9.0)]
    third = [row(7, 5, 0.0), row(8, 6, 9.0), row(9, 90, 9.0, "other")]
    _, stream = feed(spark, [first, second, third, [row(10, 91, 1.0, "other")]])
    with streams.rocks(spark):
        got = streams.drain_append(streams.sensor_state(stream, limit=5.0)).collect()
    seen = [(r.streak, r.breaches, r.last_value) for r in sorted(got, key=lambda r: r.seen_at) if r.sensor_id == "s" and r.event == "seen"]
    assert seen == [(1, 2, 9.0), (3, 4, 9.0), (1, 5, 9.0)]
    assert [r.sensor_id for r in got if r.event == "silent"].count("quiet") == 1


def test_upsert_per_batch(spark):
    _, stream = feed(spark, [[row(1, 0, 1.0), row(2, 1, 2.0), row(3, 0, 3.0, "b")], [row(4, 2, 4.0)]])
    path = work_dir(spark)
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    streams.upsert_each(stream, path, "sensor_id", ["measurement_timestamp", "id"])
    got = {r.sensor_id: r.measurement_value for r in spark.read.schema(stream.schema).parquet(path).collect()}
    assert got == {"s": 4.0, "b": 3.0}


def test_upsert_log(spark):
    """Batches wait in the log and are merged every second one; readers see both, and a merge that is repeated changes nothing."""
    from hangarflow.sources import tables

    batches = [[row(1, 0, 1.0), row(2, 1, 2.0)], [row(3, 0.5, 3.0)], [row(4, 2, 4.0), row(5, 1, 5.0, "b")]]
    folder, stream = feed(spark, batches[:1])
    path, mark = work_dir(spark), work_dir(spark)
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    now = lambda: {r.sensor_id: r.measurement_value for r in streams.current(spark, path, stream.schema, "sensor_id", ["measurement_timestamp", "id"]).collect()}
    seen = []
    merge = tables.upsert_path

    def counted(source, *a, **b):
        seen.append(source.count())
        merge(source, *a, **b)
        return merge(source, *a, **b)

    tables.upsert_path = counted
    try:
        streams.upsert_each(stream, path, "sensor_id", ["measurement_timestamp", "id"], checkpoint=mark, every=2)
        assert now() == {"s": 2.0} and seen == [1]  # the last of the key only
        for b in batches[1:]:
            spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        again = streams.read(spark, folder, stream.schema, "*.parquet", files_per_batch=1)
        streams.upsert_each(again, path, "sensor_id", ["measurement_timestamp", "id"], checkpoint=mark, every=2)
    finally:
        tables.upsert_path = merge
    assert now() == {"s": 4.0, "b": 5.0} and tables.logged(spark, path, stream.schema) is None
    spark.createDataFrame([(9, 1, "c", "temperature", at(1), 7.0)], SCHEMA).withColumn("_batch", F.lit(7).cast("long")).write.parquet(f"{tables.log_path(path)}/7")
    assert now() == {"s": 4.0, "b": 5.0, "c": 7.0}
    assert spark.read.schema(stream.schema).parquet(path).count() == 2  # readers of the table alone don't see the log


def test_dropped_partitions_are_not_read(spark):
    """Old folders go by name alone: their files aren't even Parquet."""
    import pathlib

    from hangarflow.sources import tables

    path = work_dir(spark)
    rows = spark.range(40).select("id", F.date_add(F.lit("2024-01-28").cast("date"), (F.col("id") % 8).cast("int")).alias("day"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("kind"))
    rows.union(spark.sql("SELECT 99L, cast(null AS date), 'a'")).write.partitionBy("kind", "day").parquet(path)
    local = pathlib.Path(path.removeprefix("file:"))
    for old in local.glob("kind=*/day=2024-01-*/*"):
        old.write_bytes(b"no rows here")
    assert tables.drop_partitions(spark, path, "day", "2024-02-01") == ["2024-01-28", "2024-01-29", "2024-01-30", "2024-01-31"]
    left = spark.read.parquet(path)
    assert left.count() == 21 and left.where("day < '2024-02-01'").count() == 0 and left.where("day IS NULL").count() == 1
    assert tables.drop_partitions(spark, path, "day", "2024-02-01") == []


def test_windows_end(spark):
    """Closed windows are appended once and leave the state; the final pass closes the rest; all equal the batch query."""
    batches = [[row(i, i * 0.25) for i in range(40)], [row(100 + i, 200 + i * 0.25, 2.0) for i in range(40)], [row(200, 400)], [row(201, 400.5)]]
    _, stream = feed(spark, batches)
    whole = spark.createDataFrame([r for b in batches for r in b], SCHEMA)
    for build in (lambda r: streams.windowed(r, "1 hour"), lambda r: streams.windowed(r, "3 hours", "1 hour"), streams.sessions):
        log, path, mark = [], work_dir(spark), work_dir(spark)
        first = streams.drain_closed(build, stream, path=path, checkpoint=mark, end=False, log=log)
        rows = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()))
        want = rows(build(whole))
        open_ = [w for w in want if w not in rows(first)]
        state = [p["stateOperators"][-1]["numRowsTotal"] for p in log if p["stateOperators"]]
        assert 0 < len(open_) <= 3 and len(open_) < len(want) and state[-1] <= 3  # of the last hours only
        last = streams.drain_closed(build, stream, path=path, checkpoint=mark, log=log)
        assert rows(last) == want
        assert [p["stateOperators"][-1]["numRowsTotal"] for p in log if p["stateOperators"]][-1] == 0
        assert rows(streams.drain_closed(build, stream, path=path, checkpoint=mark)) == want  # ended already


def test_end_of_a_stream_without_rows(spark):
    folder = work_dir(spark)
    spark.createDataFrame([], SCHEMA).write.parquet(folder)
    stream = streams.read(spark, folder, spark.createDataFrame([], SCHEMA).schema, "*.parquet")
    assert streams.drain_closed(streams.sessions, stream).collect() == []


def test_a_million_breaches_in_one_batch(spark):
    """Workers hold a piece of the batch at a time: the lists they make are of pieces, and are cleared at the end."""
    n = 1_000_000
    folder = work_dir(spark)
    spark.range(n).select("id", F.lit(1).cast("long").alias("aircraft_id"), F.lit("s").alias("sensor_id"), F.lit("temperature").alias("sensor_type"),
                          F.timestamp_seconds(F.col("id") + 1_704_067_200).alias("measurement_timestamp"),
                          F.when(F.col("id") == 400_000, 0.0).otherwise(9.0).alias("measurement_value")).coalesce(1).write.parquet(folder)
    stream = streams.read(spark, folder, spark.createDataFrame([], SCHEMA).schema, "*.parquet")
    with streams.rocks(spark):
        got = streams.drain_append(streams.sensor_state(stream, limit=5.0)).collect()
    assert [(r.event, r.streak, r.breaches) for r in got] == [("seen", n - 400_001, n - 1)]


def test_sessions_and_alerts(spark):
    _, stream = feed(spark, [[row(1, 0, 200.0), row(2, 5), row(3, 12)]])
    got = sorted((r.session_start, r.readings) for r in streams.drain_closed(streams.sessions, stream).collect())
    assert got == [(at(0), 2), (at(12), 1)]
    _, stream = feed(spark, [[row(1, 0, 200.0), row(2, 5, 150.0), row(3, 12, 149.9)]])
    assert streams.drain_append(streams.alerts(stream)).count() == 2
