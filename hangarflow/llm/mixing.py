"""Mixing sources to target weights: fixed-length blocks, drawn by source and joined by index.

The words of each source make one stream, in an order of hashes of its documents, cut into blocks of ``length`` words; the
last may be shorter. A source's target is its weighted share of the mix, at most ``most`` times its size; what
is above goes to the other sources by weight. The mix is a sequence of slots, dealt to ``shards`` output
shards. Each slot of a shard draws its source independently by the target shares, so that a shard's counts by source
are one multinomial draw. A source's slots are numbered through all shards, and slot i takes block p(i mod blocks) of
its stream, p a pseudorandom permutation of the block numbers, another one for each pass over the source:
no block comes again before all others had their turn. Draws beyond a source's target are turned over to
the sources that were drawn too rarely, and the last slot of a source is cut, so that each source's taken words are its target,
rounded to a whole word.

The permutation is swap-or-not: in each round a number and its mirror image change places if a bit
hashed from the larger of them says so. That is a bijection of any range, without a table, a sort or a search.

Nothing depends on the order or the partitioning of the input. No stream passes through one task: documents
are dealt to ``buckets`` buckets of each source, positions are running sums within a bucket plus those of the buckets
before it. Only the sources themselves (one row each) and the counts by shard and by bucket are summed up in one place per source.
Equal rows are counted before they are dealt; each copy is a document of its own in the stream.

Null and empty texts have size 0 and are never taken; a null source is a source of its own, the last; null ids are ids.
A source without words has target 0. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hangarflow.llm.common import SPACES, pick, query, stored, table

WEIGHTS, SHARE, MOST, LENGTH, SHARDS, BUCKETS, ROUNDS, COPIES = (3, 1, 2), 1.5, 2, 512, 1024, 1024, 32, 4096
KEY = ["src", "doc_id", "v", "copy"]


def words(name: str = "text") -> Column:
    """The words of a text; none if it is null."""
    return F.array_remove(F.split(F.translate(F.coalesce(F.col(name), F.lit("")), SPACES, " " * len(SPACES)), " ", -1), "")


def permuted(x: Column, n: Column, *key: Column, back: bool = False, rounds: int = ROUNDS) -> Column:
    """The number that a permutation of 0 .. n - 1, one for each ``key``, puts at place x; with ``back``, the place of a number."""
    def swap(at: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) + n - at, n)
        return F.when(F.xxhash64(*key, r, F.greatest(at, other)) > 0, other).otherwise(at)

    turns = F.sequence(F.lit(rounds - 1), F.lit(0), F.lit(-1)) if back else F.sequence(F.lit(0), F.lit(rounds - 1))
    return F.aggregate(turns, x.cast("long"), swap)


def members(docs: DataFrame) -> DataFrame:
    """(source, doc_id, v, copy, size): a row for each row of ``docs``, equal ones numbered; v hashes the text."""
    own = pick(docs, "source", "doc_id", "text").select("source", "doc_id", F.xxhash64("text").alias("v"), F.size(words()).cast("long").alias("size"))
    many = own.groupBy("source", "doc_id", "v", "size").agg(F.count(F.lit(1)).alias("c"))
    some = many.withColumn("hi", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(c - 1) div {COPIES}"))))
    copy = F.explode(F.sequence(F.col("hi") * COPIES, F.least("c", F.col("hi") * COPIES + COPIES) - 1))
    return some.select("source", "doc_id", "v", "size", copy.alias("copy"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(src, source, size, target) of sizes (source, size); sources in order of their names, null last, have the weights in turn.

    Sorted by the level at which they are full, the sources before one are full and those from it on share the rest; the
    highest such level is the one that meets the total. One row for each source takes part.
    """
    every = Window.orderBy(F.asc_nulls_last("source"))
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    w = sizes.withColumn("src", F.row_number().over(every) - 1)
    w = w.withColumn("w", F.get(cycle, F.col("src") % len(weights))).withColumn("most", F.col("size") * float(most))
    full = Window.orderBy(F.col("most") / F.col("w"), "src")
    before = F.coalesce(F.sum("most").over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(full.rowsBetween(0, Window.unboundedFollowing))
    all_rows = full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = w.withColumn("level", (F.sum("size").over(all_rows) * share - before) / rest)
    return level.select("src", "source", "size", F.least(F.col("most"), F.max("level").over(all_rows) * F.col("w")).alias("target"))


def planned(sources: DataFrame, length: int = LENGTH, seed: int = 0) -> DataFrame:
    """``sources`` with blocks, short (length of the last block), slots (how many the target takes) and cut (words of the last slot)."""
    size = F.col("size")
    p = sources.withColumn("blocks", F.expr(f"greatest(1, (size + {length - 1}) div {length})")).withColumn("short", size - (F.col("blocks") - 1) * length)
    p = p.withColumn("want", F.floor(F.col("target") + 0.5).cast("long"))
    p = p.withColumn("passes", F.when(size > 0, F.expr("want div greatest(1, size)")).otherwise(0)).withColumn("rest", F.col("want") - F.col("passes") * size)
    p = p.withColumn("at", permuted(F.col("blocks") - 1, F.col("blocks"), F.lit(seed), F.col("src"), F.col("passes"), back=True))
    plain, gap = F.expr(f"(rest + {length - 1}) div {length}"), length - F.col("short")
    p = p.withColumn("part", F.when(F.col("at") >= plain, plain).otherwise(F.expr(f"(rest + {length} - short + {length - 1}) div {length}")))
    p = p.withColumn("part", F.when(F.col("rest") > 0, F.col("part")).otherwise(0))
    cut = F.col("rest") - (F.col("part") - 1) * length + F.when(F.col("at") < F.col("part") - 1, gap).otherwise(0)
    return p.select("src", "source", "size", "target", "blocks", "short", (F.col("passes") * F.col("blocks") + F.col("part")).alias("slots"), F.when(F.col("part") > 0, cut).alias("cut"))


def drawn(plan: DataFrame, length: int = LENGTH, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """(shard, slot, src, block, take): the block of each slot and how many of its words, from its start, are taken."""
    spark = plan.sparkSession
    total = plan.agg(F.coalesce(F.sum("slots"), F.lit(0)).alias("n")).first()["n"]
    each = max(1, -(-total // shards))
    until = lambda df, c: df.agg(F.array_sort(F.collect_list(F.struct("src", c))).alias("a")).select(F.transform("a", lambda x: x[c])).scalar()
    upto = plan.select("src", F.sum("slots").over(Window.orderBy("src")).alias("end"))
    r = F.pmod(F.xxhash64(F.lit(seed), F.lit("slot"), F.col("id")), F.lit(max(1, total)))
    slots = spark.range(total).withColumn("end", until(upto, "end")).select(
        F.expr(f"id div {each}").alias("shard"), (F.col("id") % each).alias("slot"), F.size(F.filter("end", lambda e: e <= r)).alias("src"))
    counts = stored(slots.groupBy("shard", "src").agg(F.count(F.lit(1)).alias("n")))
    first = counts.select("shard", "src", (F.sum("n").over(Window.partitionBy("src").orderBy("shard")) - F.col("n")).alias("first"))
    own = Window.partitionBy("shard", "src").orderBy("slot")
    numbered = slots.withColumn("i", F.row_number().over(own) - 1).join(first, ["shard", "src"]).withColumn("i", F.col("first") + F.col("i"))
    # Sources drawn too often give their last slots, in order, to those drawn too rarely.
    had = plan.join(counts.groupBy("src").agg(F.sum("n").alias("had")), "src", "left").withColumn("had", F.coalesce("had", F.lit(0)))
    had = had.withColumn("over", F.greatest(F.col("had") - F.col("slots"), F.lit(0))).withColumn("under", F.greatest(F.col("slots") - F.col("had"), F.lit(0)))
    had = stored(had.select("src", "had", "slots", "under", *((F.sum(c).over(Window.orderBy("src")) - F.col(c)).alias(f"{c}_first") for c in ("over", "under"))))
    late = numbered.join(had.select("src", "slots", "over_first"), "src").withColumn("o", F.col("over_first") + F.col("i") - F.col("slots"))
    ends = had.select("src", (F.col("under_first") + F.col("under")).alias("end"))
    starts = had.select("src", (F.col("had") - F.col("under_first")).alias("start"))
    late = late.withColumn("end", until(ends, "end")).withColumn("start", until(starts, "start"))
    to = F.size(F.filter("end", lambda e: e <= F.col("o")))
    moved = late.select("shard", "slot", F.when(F.col("o") < F.col("over_first"), F.struct("src", "i")).otherwise(
        F.struct(to.alias("src"), (F.get("start", to) + F.col("o")).alias("i"))).alias("to")).select("shard", "slot", "to.*")
    s = moved.join(plan.select("src", "blocks", "short", "slots", "cut"), "src")
    block = permuted(F.col("i") % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("src"), F.expr("i div blocks"))
    s = s.withColumn("block", block)
    whole = F.when(F.col("block") == F.col("blocks") - 1, F.col("short")).otherwise(length)
    return s.select("shard", "slot", "src", "block", F.when(F.col("i") == F.col("slots") - 1, F.coalesce("cut", whole)).otherwise(whole).alias("take"))


def placed(held: DataFrame, buckets: int = BUCKETS, seed: int = 0) -> DataFrame:
    """(src, doc_id, v, copy, size, start) of held (src, doc_id, v, copy, size): where each document starts in its source's stream."""
    dealt = held.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), *KEY), F.lit(buckets)))
    sums = dealt.groupBy("src", "bucket").agg(F.sum("size").alias("n"))
    first = sums.select("src", "bucket", (F.sum("n").over(Window.partitionBy("src").orderBy("bucket")) - F.col("n")).alias("first"))
    own = Window.partitionBy("src", "bucket").orderBy(F.xxhash64(F.lit(seed + 1), *KEY), "doc_id", "v", "copy").rowsBetween(Window.unboundedPreceding, 0)
    ran = dealt.withColumn("start", F.sum("size").over(own) - F.col("size")).join(first, ["src", "bucket"])
    return ran.select(*KEY, "size", (F.col("first") + F.col("start")).alias("start"))


def spans(length: int = LENGTH) -> Column:
    """The parts of a placed document: block, at (place in the block), first (word of the document) and n."""
    def part(b: Column) -> Column:
        low, high = F.greatest("start", b * length), F.least(F.col("start") + F.col("size"), (b + 1) * length)
        return F.struct(b.alias("block"), (low - b * length).alias("at"), (low - F.col("start")).alias("first"), (high - low).alias("n"))

    numbers = F.sequence(F.expr(f"start div {length}"), F.expr(f"(start + size - 1) div {length}"))
    return F.when(F.col("size") > 0, F.transform(numbers, part))


class Mix(NamedTuple):
    """``plan`` by source, ``slots`` and ``documents`` (placed); all stored."""

    plan: DataFrame
    slots: DataFrame
    documents: DataFrame
    length: int


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST, length: int = LENGTH,
        shards: int = SHARDS, buckets: int = BUCKETS, seed: int = 0) -> Mix:
    """The mix of all rows of ``docs``: ``share`` times their words, no word more than ``most`` times."""
    held = stored(members(docs))
    plan = stored(planned(targets(held.groupBy("source").agg(F.sum("size").alias("size")), weights, share, most), length, seed))
    named = plan.select("src", F.col("source").alias("name"))
    numbered = held.join(named, F.col("source").eqNullSafe(F.col("name"))).select(*KEY, "size")
    return Mix(plan, stored(drawn(plan, length, shards, seed)), stored(placed(numbered, buckets, seed)), length)


def taken(m: Mix) -> DataFrame:
    """(source, doc_id, v, copy, size, source_size, target, taken) for each document: how many of its words the mix takes, repeats counted."""
    parts = m.documents.select(*KEY, "size", F.explode_outer(spans(m.length)).alias("s")).select(*KEY, "size", "s.block", "s.at", "s.n")
    takes = m.slots.groupBy("src", "block").agg(F.collect_list("take").alias("takes"))  # as many as there are passes
    one = lambda t: F.greatest(F.lit(0), F.least(F.col("n"), t - F.col("at")))
    got = F.coalesce(F.aggregate("takes", F.lit(0).cast("long"), lambda s, t: s + one(t)), F.lit(0))
    of = parts.join(takes, ["src", "block"], "left").groupBy(*KEY, "size").agg(F.sum(got).alias("taken"))
    plan = m.plan.select("src", "source", F.col("size").alias("source_size"), "target")
    return of.join(plan, "src").select("source", "doc_id", "v", "copy", "size", "source_size", "target", "taken")


def texts(m: Mix, docs: DataFrame) -> DataFrame:
    """(shard, slot, source, text): the mix itself; the words of a slot's block, one blank between them. ``docs`` is what ``m`` was made of."""
    names = m.plan.select("src", F.col("source").alias("name"))
    once = pick(docs, "source", "doc_id", "text").withColumn("w", F.xxhash64("text")).groupBy("source", "doc_id", "w").agg(F.first("text").alias("text"))
    once = once.join(names, F.col("source").eqNullSafe(F.col("name"))).select(F.col("src").alias("s"), F.col("doc_id").alias("d"), "w", words().alias("words"))
    on = (F.col("src") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("v") == F.col("w"))
    parts = m.documents.where("size > 0").join(once, on).select("src", "copy", "doc_id", "v", F.explode(F.transform(spans(m.length), lambda x: F.struct(
        x["block"].alias("block"), x["at"].alias("at"), F.slice("words", (x["first"] + 1).cast("int"), x["n"].cast("int")).alias("words")))).alias("p"))
    blocks = parts.select("src", "p.*").groupBy("src", "block").agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("p"))  # at most ``length`` words
    blocks = blocks.select("src", "block", F.flatten(F.transform("p", lambda x: x["words"])).alias("words"))
    out = m.slots.join(blocks, ["src", "block"]).join(m.plan.select("src", "source"), "src")
    return out.select("shard", "slot", "source", F.array_join(F.slice("words", F.lit(1), F.col("take").cast("int")), " ").alias("text"))


@query("op12_mixing")
def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(mix(table(spark, sf_dir, "documents"))).select("doc_id", "size", "source_size", "target", "taken")
