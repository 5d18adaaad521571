"""Appending, upserting, sampling and versioning of tables kept as Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from hangarflow import rules
from hangarflow.operators import ordered
from hangarflow.operators.ordered import names
from hangarflow.session import staged


def sql(spark: SparkSession, text: str, args=None, fetch: str = "all"):
    """SQL text with positional or named parameters. ``all``: DataFrame, ``one``: row or None, ``none``: run only."""
    df = spark.sql(text, args=args)
    if fetch == "all":
        return df
    if fetch == "one":
        return df.first()
    if fetch == "none":
        df.write.format("noop").mode("overwrite").save()
        return None
    raise ValueError(f"unknown fetch mode {fetch!r}")


def sample(df: DataFrame, n: int = 10, columns=None, order=()) -> DataFrame:
    """First ``n`` rows in a stated order."""
    picked = df.orderBy(*order) if order else df
    picked = picked.limit(n)
    return picked.select(*columns) if columns else picked


def stats(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.min(ts).alias("min_date"), F.max(ts).alias("max_date"))


def _write_counted(df: DataFrame, path: str, mode: str, by=()) -> int:
    seen = Observation("written")
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return seen.get["n"]


def new_rows(batch: DataFrame, target: DataFrame, keys, order: Sequence[str]) -> DataFrame:
    """Batch rows whose key is not in the target; the first of a repeated key counts."""
    from hangarflow.operators.cleaning import keep_first

    keys = names(keys)
    return keep_first(batch, keys, order).join(target.select(*keys), keys, "left_anti")


def append(df: DataFrame, path: str, keys=None, on_conflict: str = "error", order=()) -> int:
    """Append and return the rows written. ``ignore`` skips known keys, ``error`` refuses them."""
    if on_conflict not in ("error", "ignore"):
        raise ValueError(f"unknown conflict mode {on_conflict!r}")
    if keys is None:
        return _write_counted(df, path, "append")
    target = df.sparkSession.read.schema(df.schema).parquet(path)
    if on_conflict == "ignore":
        fresh = staged(new_rows(df, target, keys, list(order) or df.columns))
        return _write_counted(fresh, path, "append")
    known = df.join(target.select(*names(keys)), names(keys), "left_semi").limit(1).count()
    repeated = df.groupBy(*names(keys)).count().where("count > 1").limit(1).count()
    if known or repeated:
        raise ValueError("batch holds keys that already exist")
    return _write_counted(df, path, "append")


def upsert(target: DataFrame, source: DataFrame, keys, order: Sequence[str], update_columns=None) -> DataFrame:
    """The table after the upsert: the last source row of a key wins, listed columns are updated.

    The winner is found by ``max_by``, which combines map-side, so a key repeated
    in a third of the batch is no hot spot.
    """
    keys = names(keys)
    rest = [c for c in target.columns if c not in keys]
    update = set(update_columns or rest)
    carried = [c for c in rest if c in source.columns]
    last = source.groupBy(*keys).agg(F.max_by(F.struct(*carried), F.struct(*order)).alias("_src"))
    both = target.withColumn("_old", F.lit(True)).join(last, keys, "full")
    inserted, matched = F.col("_old").isNull(), F.col("_src").isNotNull()
    out = []
    for c in target.columns:
        if c in keys or c not in carried:
            out.append(F.col(c))
            continue
        take = (inserted | (matched & F.lit(c in update)))
        out.append(F.when(take, F.col(f"_src.{c}")).otherwise(F.col(c)).alias(c))
    return both.select(*out)


def upsert_path(source: DataFrame, path: str, keys, order, update_columns=None, by=(), schema=None) -> int:
    """Upsert into a Parquet folder, rewriting only the partitions the batch touches.

    Partition columns must belong to the key, so a key never moves. The result is
    staged in the shared folder first: a table is never read and overwritten in
    one job, and a failed overwrite can be repeated from the staged copy.
    """
    spark = source.sparkSession
    by = names(by) if by else []
    if not set(by) <= set(names(keys)):
        raise ValueError("partition columns must be part of the key")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    target = reader.parquet(path)
    if by:
        target = target.join(source.select(*by).distinct(), by, "left_semi")
    merged = staged(upsert(target, source, keys, order, update_columns))
    seen = Observation("upserted")
    counted = merged.observe(seen, F.count(F.lit(1)).alias("n"))
    writer = counted.write.mode("overwrite")
    if by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    writer.parquet(path)
    return seen.get["n"]


#: Number of the micro-batch in a table's log.
BATCH = "_batch"


def log_path(path: str) -> str:
    """Where batches wait to be merged into the table: beside it, for a table without partitions is overwritten as a whole."""
    return f"{path.rstrip('/')}-log"


def logged(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """All rows of a table's log, with the number of their batch; None if nothing waits."""
    at = spark._jvm.org.apache.hadoop.fs.Path(log_path(path))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [str(x.getPath()) for x in fs.listStatus(at)] if fs.exists(at) else []
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(*sorted(folders)) if folders else None


def clear_log(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(log_path(path))
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_partitions(spark: SparkSession, path: str, column: str, before: str) -> list[str]:
    """Delete the partitions ``column=value`` whose value (as text, dates in ISO form) is less than ``before``; the values deleted.

    Only folder names are looked at, no row is read. Partitions of other columns above ``column`` are searched too; those of null and
    names that aren't partitions stay.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone, left = [], [root]
    while left:
        for x in fs.listStatus(left.pop()):
            name, _, value = x.getPath().getName().partition("=")
            if not x.isDirectory() or not value:
                continue
            if name != column:
                left.append(x.getPath())
            elif value != "__HIVE_DEFAULT_PARTITION__" and value < before:
                fs.delete(x.getPath(), True)
                gone.append(value)
    return sorted(gone)


def scd2(changes: DataFrame, by: str, ts: str, value: str, tie: str, width: int | None = 30 * ordered.DAY) -> DataFrame:
    """Versions of an attribute with start, end, current flag and number.

    Of several changes at one time the last counts; a repeated value opens no version.
    """
    once = changes.groupBy(by, ts).agg(F.max_by(value, tie).alias(value))
    stepped = ordered.previous(once, by, ts, {"_before": value, "_seen": ts}, width=width)
    starts = stepped.where(F.col("_seen").isNull() | ~F.col(value).eqNullSafe(F.col("_before"))).select(by, ts, value)
    # Each scan below reads its input twice; only the real changes are kept for that.
    starts = staged(starts)
    ends = ordered.nearest_seen(starts, by, ts, {"_end": (F.col(ts), F.lit(True))}, width=width, forward=True, inclusive=False)
    numbered = ordered.row_index(ends, by, ts, "version_number", width=width)
    return numbered.select(
        by, value, F.col(ts).alias("effective_start_date"),
        F.coalesce("_end", F.lit(rules.OPEN_END).cast("timestamp")).alias("effective_end_date"),
        F.col("_end").isNull().alias("is_current"), F.col("version_number").cast("int").alias("version_number"),
    )
