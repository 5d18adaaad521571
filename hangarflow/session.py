"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SCRATCH_CONF = "hangarflow.scratch"


def build(app: str = "hangarflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator expects (UTC, AQE, ANSI)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin the zone on a session somebody else built; times are stored as UTC.

    The JVM never compiles methods of more than 8000 bytes of bytecode, and with some 80 columns a whole stage becomes such a method, which
    is then interpreted row by row. Beyond that size Spark is told to generate an operator at a time, in small methods.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def work_dir(spark: SparkSession) -> str:
    """A fresh folder under the shared checkpoint folder of the cluster, or under the open :func:`scratch`.

    Only a local-mode session without that setting (tests) may fall back to the
    machine's own temporary folder: executors elsewhere could not read it back.
    """
    base = spark.conf.get(SCRATCH_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="hangarflow-")
        spark.conf.set(CHECKPOINT_CONF, base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession):
    """A scope for intermediate tables: all folders that operators make inside are deleted at its end.

    Results that are to stay must be written elsewhere before, for frames are lazy and may read those folders.
    """
    outer, path = spark.conf.get(SCRATCH_CONF, None), work_dir(spark)
    spark.conf.set(SCRATCH_CONF, path)
    try:
        yield path
    finally:
        if outer:
            spark.conf.set(SCRATCH_CONF, outer)
        else:
            spark.conf.unset(SCRATCH_CONF)
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def staged(df):
    """Write once to the shared folder and read back, for results used several times.

    Columnar, so later passes read only their columns; survives lost executors.
    """
    path = work_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
