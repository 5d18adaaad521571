"""Training-data pipeline: documents in, BPE ids of clean, distinct documents out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next one's ``docs``. All but the last return the columns of ``docs``. Rows without id, repeated rows and empty
texts go through; what each stage does with them is said at its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hangarflow.llm import bpe, decontam, langid, linededup, minhash
from hangarflow.llm.common import pick, stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or like no language that the labelled ones teach, go."""
    names = [f"_{i}" for i in range(len(docs.columns))]
    known = langid.identify(docs)
    return known.toDF(*names, "_language").where(langid.reliable()).select(*names).toDF(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in ten documents or more go; the documents stay, n_chars follows their text."""
    return linededup.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (five-word shingles) stays, that of the least id, then text hash, null ids last.

    Rows with the same id and text are one document, whatever their other columns: the one that is first as JSON stays.
    """
    judged = stored(minhash.judged(docs).select("doc_id", "v", "stays"))
    gone = stored(judged.where("NOT stays").select("doc_id", "v").distinct())
    twice = stored(judged.where("stays").groupBy("doc_id", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "v"))
    names = [f"_{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    doc_id, text = (plain[names[docs.columns.index(n)]] for n in ("doc_id", "text"))
    same = lambda keys: doc_id.eqNullSafe(keys["doc_id"]) & (F.xxhash64(text) == keys["v"])
    kept = plain.join(gone, same(gone), "left_anti")
    # Not as a set of rows: columns may be maps, which have no equality.
    whole, order = F.struct(*names), F.to_json(F.struct(*[F.struct(n) for n in names]))
    once = kept.join(twice, same(twice), "left_semi").groupBy(doc_id.alias("_id"), F.xxhash64(text).alias("_v")).agg(F.min_by(whole, order).alias("_row"))
    return kept.join(twice, same(twice), "left_anti").union(once.select("_row.*")).toDF(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words of a benchmark item in a row, or a whole shorter item, go."""
    names = [f"_{i}" for i in range(len(docs.columns))]
    key = F.xxhash64(*(names[docs.columns.index(n)] for n in ("doc_id", "text")))
    plain = docs.toDF(*names).withColumn("_key", key)
    own = plain.select(F.col("_key").alias("doc_id"), F.col(names[docs.columns.index("text")]).alias("text"))
    _, terms = decontam.phrases(table(spark, sf_dir, "benchmark"))
    found = decontam.exact(decontam.postings(own, terms), terms)
    hit = stored(found.select(F.col("doc_id").alias("_key")).distinct())
    return plain.join(hit, "_key", "left_anti").select(*names).toDF(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the packed ids and of their decoding."""
    return bpe.digests(bpe.encoded(pick(docs, "doc_id", "text")))


STAGES = [
    ("language_id", language), ("line_dedup", lines), ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated), ("bpe", tokens),
]
#: SQL expresses neither the language profiles nor BPE; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
