"""Structured Streaming forms of the load, the windows, the alerts and the upsert."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

from hangarflow import rules
from hangarflow.operators import cleaning, decisions
from hangarflow.session import work_dir
from hangarflow.sources import tables

LATENESS = f"{rules.FRESHNESS_HOURS} hours"
#: Event time of the row that ends a stream; no reading has it.
END = "9999-01-01 00:00:00"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read(spark: SparkSession, folder: str, schema, pattern: str, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def drain_append(df: DataFrame, by: Sequence[str] = (), path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run until the source is read and return what was appended. Restart with the same paths adds no duplicates."""
    spark = df.sparkSession
    path, checkpoint = path or work_dir(spark), checkpoint or work_dir(spark)
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    (writer.partitionBy(*by) if by else writer).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def _run(df: DataFrame, path: str, checkpoint: str, log: list | None) -> None:
    run = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    if log is not None:
        log += run.recentProgress


def drain_closed(build: Callable[[DataFrame], DataFrame], stream: DataFrame, ts="measurement_timestamp", path: str | None = None,
                 checkpoint: str | None = None, end: bool = True, log: list | None = None) -> DataFrame:
    """Windows or sessions that ``build`` makes of the stream, each appended once, when the watermark closes it.

    State holds open windows only. With ``end`` the last ones are closed by a final pass: a second source, whose folder belongs
    to the checkpoint, gets one row of event time END, which moves the watermark past all windows; whatever comes later
    is late. Without it the open windows stay in the state and a restart with the same paths goes on with them. ``log`` collects the
    progress of the batches.
    """
    spark = stream.sparkSession
    path, checkpoint = path or work_dir(spark), checkpoint or work_dir(spark)
    folder = f"{checkpoint.rstrip('/')}-end"
    spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(folder)
    df = build(stream.unionByName(spark.readStream.schema(stream.schema).parquet(folder)))
    _run(df, path, checkpoint, log)
    if end:
        # A row of nulls but for its time.
        last = [F.lit(END if c == ts else None).cast(kind).alias(c) for c, kind in stream.dtypes]
        spark.range(1).select(*last).coalesce(1).write.mode("append").parquet(folder)
        _run(df, path, checkpoint, log)
    return spark.read.schema(df.schema).parquet(path)


def _watched(stream: DataFrame, ts: str, lateness: str) -> DataFrame:
    """With a watermark, and without the row that ends the stream; the condition stays above the watermark, for it is on its time."""
    return stream.withWatermark(ts, lateness).where(F.col(ts) < F.lit(END).cast("timestamp"))


def bronze(stream: DataFrame, ts="measurement_timestamp", lateness=LATENESS) -> DataFrame:
    """Readings with a lateness bound and their day for the folder layout."""
    return stream.withWatermark(ts, lateness).withColumn("day", F.to_date(ts))


def dedup(stream: DataFrame, keys: Sequence[str], ts="measurement_timestamp", lateness=LATENESS) -> DataFrame:
    """First arrival of each key; state is dropped once the watermark passes it."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(keys))


def _stats(value):
    return [F.count(value).alias("readings"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"), F.max(value).alias("max")]


def windowed(stream: DataFrame, size: str, slide: str | None = None, keys=("sensor_type",), ts="measurement_timestamp",
             value="measurement_value", lateness="1 hour") -> DataFrame:
    """Tumbling (no ``slide``) or sliding statistics per key."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return _watched(stream, ts, lateness).groupBy(*keys, w.alias("w")).agg(*_stats(value)).select(
        *keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "readings", "mean", "std", "min", "max")


def sessions(stream: DataFrame, gap: str = "6 hours", by="aircraft_id", ts="measurement_timestamp", lateness="1 hour") -> DataFrame:
    """Operating sessions: readings of an aircraft at most ``gap`` apart."""
    return _watched(stream, ts, lateness).groupBy(by, F.session_window(ts, gap).alias("w")).agg(
        F.count(F.lit(1)).alias("readings")).select(
        by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "readings")


def alerts(stream: DataFrame, fleet: DataFrame | None = None, by="aircraft_id") -> DataFrame:
    """Threshold alerts as readings arrive, enriched with fleet data."""
    out = decisions.threshold_alerts(stream)
    return out.join(fleet, by, "left") if fleet is not None else out


STATUS = "sensor_id string, event string, seen_at timestamp, last_value double, streak int, breaches long"
STATUS_COLUMNS = [c.split()[0] for c in STATUS.split(", ")]


class SensorState(StatefulProcessor):
    """One sensor: its last reading, streak and count of breaches, and the timer of its silence.

    A batch brings a sensor's readings in pieces, in any order. The times of breaches that are later than the newest
    sound reading so far go to a list in the state store, one entry for each piece; only when all pieces are in is it
    known which of them still count. So memory holds one piece, however many breaches there are.
    """

    def __init__(self, limit: float, silence: int, value: str):
        self.limit, self.silence, self.value = limit, silence, value

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "t long, v double, streak int, breaches long, due long")
        self.open = handle.getListState("open", "times array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        t, v, streak, breaches, due = self.last.get() if self.last.exists() else (None, None, 0, 0, None)
        known, sound = t, None
        self.open.clear()  # of a batch that failed
        for pdf in rows:
            at, hit = pdf["at_micros"].to_numpy(np.int64), (pdf[self.value] >= self.limit).to_numpy()
            breaches += int(hit.sum())
            if not hit.all():
                newest_sound = int(at[~hit].max())
                sound = newest_sound if sound is None else max(sound, newest_sound)
            late = at[hit] if sound is None else at[hit & (at > sound)]
            if len(late):
                self.open.appendValue((late.tolist(),))
            newest = int(at.argmax())
            if t is None or at[newest] >= t:
                t, v = int(at[newest]), float(pdf[self.value].iloc[newest])
        more = 0
        for (times,) in self.open.get():
            more += len(times) if sound is None else int((np.array(times) > sound).sum())
        self.open.clear()
        # A sound reading later than everything known ends the old streak; one behind the last reading doesn't.
        streak = (0 if sound is not None and (known is None or sound > known) else streak) + more
        new_due = max(t // 1000 + self.silence, timerValues.getCurrentWatermarkInMs() + 1)
        if due is not None and due != new_due:
            self.handle.deleteTimer(due)
        if due != new_due:
            self.handle.registerTimer(new_due)
        self.last.update((t, v, streak, breaches, new_due))
        yield self._row(key, "seen", t, v, streak, breaches)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        t, v, streak, breaches, _ = self.last.get()
        self.last.clear()
        yield self._row(key, "silent", t, v, streak, breaches)

    def _row(self, key, event: str, t: int, v: float, streak: int, breaches: int) -> pd.DataFrame:
        return pd.DataFrame([(key[0], event, pd.Timestamp(t, unit="us"), v, streak, breaches)], columns=STATUS_COLUMNS)

    def close(self) -> None:
        pass


@contextmanager
def rocks(spark: SparkSession):
    """State with lists and timers needs the store on disk; set for the queries started inside."""
    conf = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(conf, None)
    spark.conf.set(conf, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(conf, before) if before else spark.conf.unset(conf)


def sensor_state(stream: DataFrame, limit: float, silence_hours: int = rules.FRESHNESS_HOURS, by="sensor_id",
                 ts="measurement_timestamp", value="measurement_value", lateness="1 hour") -> DataFrame:
    """Last value and running streak of breaches per sensor after each batch; a sensor that falls silent reports once, by an event-time timer.

    Start the query inside :func:`rocks`.
    """
    keyed = stream.withWatermark(ts, lateness).select(by, ts, F.unix_micros(ts).alias("at_micros"), F.col(value).cast("double").alias(value)).groupBy(by)
    return keyed.transformWithStateInPandas(SensorState(limit, silence_hours * 3_600_000, value), STATUS, "append", "eventTime")


def upsert_each(stream: DataFrame, path: str, keys, order, by=(), update_columns=None, checkpoint: str | None = None, every: int = 8) -> None:
    """Upsert every micro-batch into a table; a batch run again after a failure gives the same table.

    A batch's rows only go to a log beside the table, reduced to the last of each key. Every
    ``every`` batches, and at the end, the log is merged into the partitions that it touches, so these are rewritten once for
    that many batches. :func:`current` reads table and log together. Merging the same log again changes nothing.
    With ``update_columns`` the columns of a new key come from its first batch, so each batch is merged by itself.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or work_dir(spark)
    schema, each = stream.schema, 1 if update_columns else every

    def merge() -> None:
        logged = tables.logged(spark, path, schema)
        if logged is not None:
            tables.upsert_path(logged, path, keys, [tables.BATCH, *order], update_columns, by, schema)
            tables.clear_log(spark, path)

    def add(batch: DataFrame, number: int) -> None:
        last = cleaning.keep_last(batch, keys, order)
        last.withColumn(tables.BATCH, F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{tables.log_path(path)}/{number}")
        if (number + 1) % each == 0:
            merge()

    (stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(add)
     .trigger(availableNow=True).start().awaitTermination())
    merge()


def current(spark: SparkSession, path: str, schema, keys, order) -> DataFrame:
    """The table with the batches that aren't merged yet."""
    table, logged = spark.read.schema(schema).parquet(path), tables.logged(spark, path, schema)
    return table if logged is None else tables.upsert(table, logged, keys, [tables.BATCH, *order])
