"""Benchmark decontamination over a distributed positional inverted index.

``postings`` stores where each term of the benchmark stands in the training documents, with the length
of every document as the posting of the empty term. A phrase is searched from its rarest term: that
term's list, shifted by its place in the phrase, gives the possible starts; the list of the next rarest
term thins them out, and the remaining lists are intersected for what is left. ``near`` finds places
where all words of a phrase stand close together in any order.

Terms that no phrase uses can't take part in a match, so their postings aren't stored. Nothing is
broadcast unless its stored size is under ``spark.sql.autoBroadcastJoinThreshold``; frequent terms meet in joins that adaptive
execution splits.

Null and empty texts have no words. Rows with one doc_id (or a null one) are one document: n_words is
that of the longest, and a place is hit if it is hit in one of them. Items with one item_id likewise
count once; an item without id is listed as an empty string. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hangarflow.llm.common import LOWER, UPPER, pick, query, stored, table

#: Words are runs of digits, letters and everything beyond ASCII; all else of ASCII parts them.
MARKS = "".join(chr(i) for i in range(128) if not chr(i).isalnum())


def words(name: str = "text") -> Column:
    """The words, A-Z in lower case. A plain split is several times as fast as matching a pattern for each word."""
    spaced = F.translate(F.col(name), UPPER + MARKS, LOWER + " " * len(MARKS))
    return F.array_remove(F.split(F.coalesce(spaced, F.lit("")), " ", -1), "")


def phrases(items: DataFrame, width: int = 10) -> tuple[DataFrame, DataFrame]:
    """(phrase, item_id) and the distinct phrases' terms (phrase, n, off, term), both stored."""
    spark = items.sparkSession
    w = pick(items, "item_id", "text").select("item_id", words().alias("w")).where(F.size("w") > 0)
    w = w.withColumn("n", F.least(F.size("w"), F.lit(width)))
    w = w.select("item_id", "n", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1), lambda i: F.slice("w", i, F.col("n")))).alias("terms"))
    w = stored(w.withColumn("phrase", F.md5(F.array_join("terms", " ").cast("binary"))))
    terms = w.select("phrase", "n", "terms").distinct().select("phrase", "n", F.posexplode("terms").alias("off", "term"))
    return w.select("phrase", "item_id").distinct(), stored(terms)


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored index (term, doc_id, pos) of the terms given; the empty term's pos is the document's length."""
    spark = docs.sparkSession
    vocabulary = stored(terms.select("term").union(spark.range(1).select(F.lit("").alias("term"))).distinct())
    where = pick(docs, "doc_id", "text").select("doc_id", F.posexplode(F.array_append(words(), F.lit(""))).alias("pos", "term"))
    return stored(where.join(vocabulary, "term", "left_semi"))


def ranked(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(phrase, n, off, term, rank): the terms of each phrase from the rarest; phrases with a term that no document has are left out."""
    df = index.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    own = Window.partitionBy("phrase")
    found = terms.join(df, "term").withColumn("have", F.count(F.lit(1)).over(own)).where("have = n")
    return found.select("phrase", "n", "off", "term", F.row_number().over(own.orderBy("df", "term", "off")).alias("rank"))


def same_doc(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def exact(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(phrase, doc_id, start, n): every place where a phrase stands word for word; stored."""
    spark = index.sparkSession
    order = stored(ranked(index, terms))
    there = index.where("term <> ''")
    first = order.where("rank = 1")
    starts = there.join(first, "term").select("phrase", "n", "doc_id", (F.col("pos") - F.col("off")).alias("start")).where("start >= 0")
    # The second list: only its places that some start calls for.
    second = order.where("rank = 2").select("phrase", "off", "term")
    second_at = there.join(second.select("term").distinct(), "term", "left_semi").select(F.col("doc_id").alias("d"), F.col("pos").alias("p"), F.col("term").alias("t"))
    called = starts.join(second, "phrase", "left").withColumn("pos", F.col("start") + F.col("off"))
    alone = called.where("term IS NULL").select("phrase", "n", "doc_id", "start")
    both = called.where("term IS NOT NULL").join(second_at, same_doc("doc_id", "d") & (F.col("pos") == F.col("p")) & (F.col("term") == F.col("t")), "left_semi")
    thinned = stored(alone.union(both.select("phrase", "n", "doc_id", "start")))
    # The other lists, of the documents that still have a start.
    held = stored(thinned.select(F.col("doc_id").alias("k")).distinct())
    rest_at = there.join(held, same_doc("doc_id", "k"), "left_semi").select(F.col("doc_id").alias("d"), F.col("pos").alias("p"), F.col("term").alias("t")).distinct()
    rest = thinned.join(order.where("rank > 2").select("phrase", "off", "term"), "phrase").withColumn("pos", F.col("start") + F.col("off"))
    full = (
        rest.join(rest_at, same_doc("doc_id", "d") & (F.col("pos") == F.col("p")) & (F.col("term") == F.col("t")), "left_semi")
        .distinct().groupBy("phrase", "n", "doc_id", "start").agg(F.count(F.lit(1)).alias("have")).where("have = n - 2")
    )
    short = thinned.where("n <= 2").distinct()
    return stored(short.union(full.select("phrase", "n", "doc_id", "start")))


def near(index: DataFrame, terms: DataFrame, span: int = 30) -> DataFrame:
    """(phrase, doc_id, at): places of a phrase's rarest word with all its distinct words, in any order, within ``span`` words.

    The other words are looked up in blocks of ``span`` words, so that the range condition is met by
    equality on (document, term, block); at most 2 x span places gather for each row.
    """
    once = terms.groupBy("phrase", "term").agg(F.min("off").alias("off"))
    once = once.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("phrase")))
    order = stored(ranked(index, once.select("phrase", F.col("n").cast("int").alias("n"), "off", "term")))
    there = index.where("term <> ''")
    anchor = there.join(order.where("rank = 1"), "term").select("phrase", "n", "doc_id", F.col("pos").alias("at"))
    others = order.where("rank > 1").select("phrase", "term")
    alone = anchor.where("n = 1").select("phrase", "doc_id", "at")
    around = anchor.join(others, "phrase").withColumn("block", F.explode(F.array(*((F.floor(F.col("at") / span) + k) for k in (-1, 0, 1)))))
    places = there.select(F.col("doc_id").alias("d"), F.col("term").alias("t"), "pos", F.floor(F.col("pos") / span).alias("b"))
    got = around.join(places, same_doc("doc_id", "d") & (F.col("term") == F.col("t")) & (F.col("block") == F.col("b"))).where(F.abs(F.col("pos") - F.col("at")) < span)
    lists = got.groupBy("phrase", "n", "doc_id", "at").agg(F.collect_set(F.struct("pos", "term")).alias("w"))
    inside = lambda s: F.size(F.array_distinct(F.transform(F.filter("w", lambda x: (x["pos"] >= s) & (x["pos"] < s + span)), lambda x: x["term"]))) + 1
    starts = F.filter(F.array_union(F.transform("w", lambda x: x["pos"]), F.array("at")), lambda s: (s <= F.col("at")) & (s > F.col("at") - span))
    return alone.union(lists.where(F.exists(starts, lambda s: inside(s) == F.col("n"))).select("phrase", "doc_id", "at"))


def report(index: DataFrame, owners: DataFrame, found: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (sorted as strings, comma-joined)."""
    size = index.where("term = ''").groupBy("doc_id").agg(F.max("pos").cast("long").alias("n_words"))
    at = found.select("doc_id", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("pos")).distinct()
    hit = at.groupBy(F.col("doc_id").alias("h")).agg(F.count(F.lit(1)).alias("n_hit"))
    who = found.select("phrase", "doc_id").distinct().join(owners, "phrase").select("doc_id", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
    who = who.groupBy(F.col("doc_id").alias("w")).agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.sort_array(F.collect_set("item")), ",").alias("items"))
    both = hit.join(who, same_doc("h", "w"))
    out = size.join(both, same_doc("doc_id", "h"), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("items", F.lit("")).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """``report`` of ``docs`` against the phrases of ``width`` words of ``items``."""
    owners, terms = phrases(items, width)
    index = postings(docs, terms)
    return report(index, owners, exact(index, terms))


_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op5_decontamination", rf"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark),
phrase AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p
  FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS u(i) WHERE len(w) > 0),
places AS (SELECT DISTINCT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM d, (SELECT DISTINCT n FROM phrase), unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n),
found AS (SELECT DISTINCT doc_id, item_id, i, n FROM places JOIN phrase USING (p, n)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM found, unnest(range(i, i + n)) AS u(j) GROUP BY doc_id),
who AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN who USING (doc_id)
""")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.col("items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
