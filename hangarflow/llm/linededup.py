"""Line dedup over levelled sorted runs of line hashes.

A run is a stored table of (line hash, number of documents), sorted by hash in each part. A new batch of
documents is counted, anti-joins the lines that the runs have settled already (seen in ``min_docs``
documents), and is stored as a new run of level 0. A level that holds ``fan`` runs is compacted into one
run of the next level. So a batch never touches the texts of earlier batches, and a line is written
O(log batches) times.

Hashes are MD5 of the whole line key, 128 bits. A document is a distinct (doc_id, text); repeated rows
count once and each of them is cleaned. A null text is an empty line; lines whose key is shorter than
``min_chars`` are never dropped. Other columns are carried along untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hangarflow.llm.common import SPACES, ascii_lower, pick, query, remove, stored, table, text_or_empty, write


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def split_lines(name: str = "text") -> Column:
    return F.split(text_or_empty(name), "\n", -1)


class LineRuns:
    """The runs of one store, by level."""

    def __init__(self, spark: SparkSession, min_docs: int = 10, fan: int = 4):
        self.spark, self.min_docs, self.fan = spark, min_docs, fan
        self.levels: list[list[str]] = [[]]

    def add(self, hashes: DataFrame) -> None:
        """Take in one batch: a row (h) for each document and distinct line."""
        counts = hashes.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
        if any(self.levels):
            counts = counts.join(self.settled(), "h", "left_anti")
        self.levels[0].append(write(counts.sortWithinPartitions("h")))
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fan:
                self._compact(level)

    def _compact(self, level: int) -> None:
        old = self.levels[level]
        merged = write(self._merged(old).sortWithinPartitions("h"))
        if level + 1 == len(self.levels):
            self.levels.append([])
        self.levels[level + 1].append(merged)
        self.levels[level] = []
        for path in old:
            remove(self.spark, path)

    def _merged(self, runs: list[str]) -> DataFrame:
        return self.spark.read.schema("h binary, n long").parquet(*runs).groupBy("h").agg(F.sum("n").alias("n"))

    def settled(self) -> DataFrame:
        """Hashes (h) of the lines that at least ``min_docs`` documents have."""
        runs = [r for level in self.levels for r in level]
        if not runs:
            return self.spark.createDataFrame([], "h binary")
        return self._merged(runs).where(F.col("n") >= self.min_docs).select("h")


def line_hashes(docs: DataFrame, min_chars: int, batches: int) -> DataFrame:
    """(batch, doc_id, v, at, h): where each line with a key of ``min_chars`` stands; v tells texts of one id apart."""
    key = F.transform(split_lines(), lambda line: F.md5(F.when(F.length(line_key(line)) >= min_chars, line_key(line)).cast("binary")))
    v = F.xxhash64("text")
    return (
        pick(docs, "doc_id", "text")
        .select(F.pmod(F.xxhash64("doc_id"), F.lit(batches)).alias("batch"), "doc_id", v.alias("v"), F.posexplode(key).alias("at", "h"))
        .where("h IS NOT NULL").withColumn("h", F.unhex("h"))
    )


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fan: int = 4) -> DataFrame:
    """All columns of ``docs`` as ``_0``, ``_1`` ... in order, and _lines, _dropped (positions, null if none), _kept.

    ``batches`` blocks of documents, by a hash of the id, go through the runs one after the other as
    arriving batches would; then every document loses the lines that the runs have settled.
    """
    spark = docs.sparkSession
    lines = stored(line_hashes(docs, min_chars, batches), "batch")
    runs = LineRuns(spark, min_docs, fan)
    for b in range(batches):
        runs.add(lines.where(F.col("batch") == b).select("doc_id", "v", "h").distinct())
    hit = lines.join(runs.settled(), "h", "left_semi").groupBy("doc_id", "v").agg(F.sort_array(F.collect_set("at")).alias("_dropped"))
    hit = hit.select(F.col("doc_id").alias("_hit_id"), F.col("v").alias("_hit_v"), "_dropped")
    names = [f"_{i}" for i in range(len(docs.columns))]
    text, doc_id = (names[docs.columns.index(n)] for n in ("text", "doc_id"))
    joined = docs.toDF(*names).withColumn("_v", F.xxhash64(text)).join(hit, F.col(doc_id).eqNullSafe(F.col("_hit_id")) & (F.col("_v") == F.col("_hit_v")), "left")
    joined = joined.withColumn("_lines", split_lines(text))
    gaps = F.transform(
        F.sequence(F.lit(0), F.size("_dropped")),
        lambda i: F.slice(
            "_lines", F.when(i == 0, 1).otherwise(F.get("_dropped", i - 1) + 2),
            F.coalesce(F.get("_dropped", i), F.size("_lines")) - F.when(i == 0, 0).otherwise(F.get("_dropped", i - 1) + 1),
        ),
    )
    kept = F.when(F.col("_dropped").isNull(), text_or_empty(text)).otherwise(F.array_join(F.flatten(gaps), "\n"))
    return joined.select(*names, "_lines", "_dropped", kept.alias("_kept"))


def cleaned(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with its columns, text without the frequent lines; a text that loses nothing stays as it is, null too."""
    out = drop_frequent_lines(docs, **options)
    cols = []
    for i, f in enumerate(docs.schema.fields):
        c = F.col(f"_{i}")
        if f.name == "text":
            c = F.when(F.col("_dropped").isNull(), c).otherwise(F.col("_kept"))
        elif f.name == "n_chars":
            c = F.when(F.col("_dropped").isNull(), c).otherwise(F.length("_kept").cast(f.dataType))
        cols.append(c.alias(f.name))
    return out.select(*cols)


_STRIP = r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"


@query("op10_line_dedup", rf"""
WITH lines AS (
  SELECT doc_id, d, rowid AS r, i AS k, string_split(coalesce(text, ''), chr(10))[i] AS line
  FROM (SELECT doc_id, text, row_number() OVER () AS rowid, dense_rank() OVER (ORDER BY doc_id, text) AS d FROM documents), unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS u(i)),
keyed AS (SELECT *, translate({_STRIP}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
often AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT d) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE key IN (SELECT key FROM often)) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE key NOT IN (SELECT key FROM often)), '')) AS kept_sha256
FROM keyed GROUP BY r, doc_id
""")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = drop_frequent_lines(docs)
    return out.select(
        F.col(f"_{docs.columns.index('doc_id')}").alias("doc_id"), F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"), F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"),
    )
