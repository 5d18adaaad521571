"""What several of the operators share."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hangarflow.session import work_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The ASCII white space of the contracts, [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Columns by their exact names, also beside others that differ in case only."""
    plain = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    return plain.select(*(plain[f"_{df.columns.index(n)}"].alias(n) for n in names))


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(c, UPPER, LOWER)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def write(df: DataFrame, *by: str) -> str:
    """Store in the shared work folder, in folders by the columns given; where."""
    path = work_dir(df.sparkSession)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return path


def stored(df: DataFrame, *by: str) -> DataFrame:
    """``df`` written to the shared work folder and read back; an empty table too."""
    return df.sparkSession.read.schema(df.schema).parquet(write(df, *by))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this run has made under the shared work folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """A public vocabulary file; HANGARFLOW_TOKENIZERS names another folder."""
    folder = os.environ.get("HANGARFLOW_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return str(public_tokenizers.path(name))
