"""Readers and writers for files; every reader takes an explicit schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from hangarflow import rules, schemas


def as_struct(schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else schemas.struct(schema)


def read(spark: SparkSession, path: str, schema, fmt: str = "parquet", pattern: str | None = None, **options) -> DataFrame:
    """Files of one source by folder, name pattern and format (csv, json, parquet, orc)."""
    reader = spark.read.schema(as_struct(schema)).format(fmt).options(**options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if fmt == "csv":
        reader = reader.option("header", options.get("header", True))
    return reader.load(path)


def load_csv(spark, path: str, schema, sep: str = ",", columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.schema(as_struct(schema)).option("header", True).option("sep", sep).csv(path)
    return df.select(*columns) if columns else df


def with_provenance(df: DataFrame, ingested_at: str) -> DataFrame:
    """Ingestion time and source file; apply right after the read."""
    return df.select("*", F.lit(ingested_at).cast("timestamp").alias("ingestion_timestamp"),
                     F.col("_metadata.file_path").alias("source_file"))


def run_to_failure(spark: SparkSession, path: str, names=None, tag: str = r"(FD\d+)") -> DataFrame:
    """Header-less whitespace text, many files in one scan, tagged by the name in the path."""
    names = names or schemas.RUN_TO_FAILURE
    cells = F.split(F.trim("value"), r"\s+")
    line = spark.read.text(path, recursiveFileLookup=True).where(F.length(F.trim("value")) > 0)
    return line.select(
        F.regexp_extract(F.col("_metadata.file_path"), tag, 1).alias("dataset"),
        *[F.try_element_at(cells, F.lit(i + 1)).try_cast("int" if n in ("engine_id", "cycle") else "double").alias(n)
          for i, n in enumerate(names)],
    )


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **options) -> None:
    df.write.format(fmt).mode(mode).options(**options).save(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_by_day(df: DataFrame, path: str, ts: str, levels=("year", "month", "day"), mode="overwrite") -> None:
    """Parquet in date folders.

    The rebalance hint groups rows by folder so each gets few files, and adaptive
    execution splits a folder that is much larger than the others.
    """
    part = {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
    tagged = df.select("*", *[part[x].alias(x) for x in levels])
    (tagged.hint("rebalance", *levels).write.mode(mode).option("compression", "snappy")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*levels).parquet(path))


def retained(df: DataFrame, ts: str, days: int, as_of: str) -> DataFrame:
    """Rows not older than ``days``; a plain range on the column, so it reaches the scan."""
    limit = F.date_sub(F.lit(as_of).cast("date"), days)
    kind = df.schema[ts].dataType
    return df.where(F.col(ts) >= limit.cast(kind))


def retention_days(layer: str) -> int:
    return rules.RETENTION_DAYS[layer]
