"""Ranked lexical search over hashed max-sketches.

The index has one row for each document: its text, its number of terms and a sketch. A sketch is two arrays
of coordinates, each at least ``load`` times as long as the document has distinct terms; a term is hashed to
one coordinate of each array, and a coordinate holds the largest term frequency that falls on it, as one
byte, rounded up. Within a document a term's impact grows with its frequency, so the impact of the smaller
of a term's two coordinates is never below its own: an upper bound, read without the text. Frequencies
rather than impacts are folded because the impact's length norm needs statistics of the whole corpus, which
are known only once all documents are in the index; the table of impacts by coordinate value is made at lookup.

A search takes the items in blocks of bounded size. For each block, one pass over the sketches looks all of
the block's terms up in all documents at once and multiplies by the term weights; the documents of the highest
bounds are scored exactly, and the k-th of their scores is the item's first threshold. A second pass goes over the
sketches again; in each task documents are scored exactly, from their text, by descending bound, until the
bounds fall below the threshold, which rises with the task's own k-th score. No document whose bound
reaches the threshold is left unscored, so results are exact. Tasks return k rows for each item at most; nothing is
shuffled but those. There is no list of postings and no join of items with documents.

Every row is a document and every row of the items an item; repeated rows rank one by one, each with a
rank of its own, by doc_id (null last), then by the hash of the text. Null texts and texts without a term
have no score and count in no statistic; an item without a term that some document has gets no row. Extra columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hangarflow.llm.common import LOWER, UPPER, pick, query, stored, table, write

MARKS = "".join(chr(i) for i in range(128) if not chr(i).isalnum())
FOLD = bytes.maketrans((UPPER + MARKS).encode(), (LOWER + " " * len(MARKS)).encode())
#: The frequencies that a coordinate's byte stands for: each up to 128, then four to a doubling.
LEVELS = np.array([*range(129), *(int(np.ceil(128 * 2 ** (i / 4))) for i in range(1, 128))], np.int64)
#: Terms that a task counts before it hands them on; documents whose bounds are held at once; cells of a block of items (terms x items).
TERMS, ROWS, CELLS = 1 << 20, 512, 1 << 22
SLACK = np.float32(1.0005)  # sums in single precision


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text, A-Z in lower case; characters beyond ASCII are part of terms."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def impacts(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def sketch(tf: Counter, load: int) -> bytes:
    """Two arrays of 2**j coordinates, one after the other; empty without terms."""
    import xxhash

    if not tf:
        return b""
    size = 1 << (load * len(tf) - 1).bit_length()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tf), np.uint64, len(tf))
    value = np.searchsorted(LEVELS, np.fromiter(tf.values(), np.int64, len(tf))).astype(np.uint8)
    out = np.zeros((2, size), np.uint8)
    for half, at in zip(out, places(h, size)):
        np.maximum.at(half, at, value)
    return out.tobytes()


def places(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each hash falls in the two arrays."""
    mask = np.uint64(size - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


class Index(NamedTuple):
    """``rows`` (row, doc_id, v, text, n, sketch) and ``terms`` (term, df), both stored; documents with a term and all their terms."""

    rows: DataFrame
    terms: DataFrame
    documents: int
    length: int


def index(docs: DataFrame, load: int = 4) -> Index:
    """The stored index of all rows of ``docs``, from one pass over the texts."""
    own = pick(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("v"), "text", F.monotonically_increasing_id().alias("row"))
    kind = f"row long, doc_id {dict(own.dtypes)['doc_id']}, v long, text string, n long, sketch binary, term binary, df long"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        names = ["row", "doc_id", "v", "text", "n", "sketch", "term", "df"]
        for batch in batches:
            empty = [pa.nulls(0, t) for t in (pa.int64(), batch.schema.field("doc_id").type, pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int64())]

            def rows(size: int, /, **columns) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(size, e.type)) for c, e in zip(names, empty)], names)

            def counted() -> pa.RecordBatch:
                out = rows(len(seen), term=pa.array(list(seen), pa.binary()), df=pa.array(list(seen.values()), pa.int64()))
                seen.clear()
                return out

            sizes, sketches = [], []
            for text in batch["text"]:
                tf = Counter(terms_of(text.as_py()))
                seen.update(tf.keys())
                sizes.append(tf.total())
                sketches.append(sketch(tf, load))
                if len(seen) >= TERMS:
                    yield counted()
            yield rows(len(batch), **{c: batch[c] for c in ("row", "doc_id", "v", "text")}, n=pa.array(sizes, pa.int64()), sketch=pa.array(sketches, pa.binary()))
        if seen:
            yield counted()

    made = stored(own.mapInArrow(build, kind))
    rows = made.where("row IS NOT NULL").drop("term", "df")
    counts = stored(made.where("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df")))
    total = rows.where("n > 0").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
    return Index(rows, counts, total["documents"], total["length"] or 0)


def weighed(items: DataFrame, idx: Index) -> DataFrame:
    """(item, item_id, weights) of the items with a term that some document has; weights (term, w), each term once; stored."""
    own = pick(items, "item_id", "text").select(F.monotonically_increasing_id().alias("item"), "item_id", "text")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            some = [sorted(set(terms_of(text))) for text in batch["text"]]
            yield pd.DataFrame({"item": batch["item"], "item_id": batch["item_id"], "term": some}).explode("term").dropna(subset=["term"])

    # Numbers of the items are fixed by being stored.
    numbered = stored(own)
    asked = numbered.mapInPandas(split, f"item long, item_id {dict(own.dtypes)['item_id']}, term binary").drop("item_id")
    w = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * idx.documents + 2) / (2 * F.col("df") + 1)))
    known = asked.join(idx.terms, "term").select("item", F.struct("term", w.cast("long").alias("w")).alias("t"))
    lists = known.groupBy("item").agg(F.sort_array(F.collect_list("t")).alias("weights"))
    return stored(numbered.select("item", "item_id").join(lists, "item"))


class Block:
    """Some items with their terms, as a task needs them."""

    def __init__(self, items: list[int], weights: list[list[tuple[bytes, int]]], documents: int, length: int):
        import xxhash

        self.items, self.weights, self.documents, self.length = items, weights, documents, length
        at = {t: i for i, t in enumerate(sorted({t for one in weights for t, _ in one}))}
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, at), np.uint64, len(at))
        self.matrix = np.zeros((len(at), len(items)), np.float32)
        for q, one in enumerate(weights):
            for t, w in one:
                self.matrix[at[t], q] = w

    def norm(self, n):
        return 50 + (50 * n * self.documents) // self.length

    def score(self, q: int, tf: Counter, m: int) -> int:
        return sum(w * impacts(tf[t], m) for t, w in self.weights[q] if t in tf)

    def bounds(self, n: np.ndarray, sketches: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, bounds by document and item) for all documents with terms, some at a time, those with sketches of one size together."""
        sizes = np.fromiter(map(len, sketches), np.int64, len(sketches))
        for size in np.unique(sizes[sizes > 0]):
            some = np.flatnonzero(sizes == size)
            first, second = places(self.hashes, int(size) // 2)
            step = max(1, min(ROWS, CELLS // len(self.hashes)))
            for i in range(0, len(some), step):
                at = some[i:i + step]
                held = np.frombuffer(b"".join(sketches[j] for j in at), np.uint8).reshape(len(at), 2, -1)
                low = np.minimum(held[:, 0, first], held[:, 1, second])
                by_level = impacts(LEVELS[None, :], self.norm(n[at])[:, None]).astype(np.float32)
                yield at, (np.take_along_axis(by_level, low.astype(np.int64), 1) @ self.matrix) * SLACK


def blocks(items: DataFrame, idx: Index) -> Iterator[tuple]:
    """What makes a Block, for all items in blocks of at most CELLS terms x items (or one item); the driver holds one block at a time."""
    ids, weights, terms = [], [], 0
    for r in items.select("item", "weights").toLocalIterator():
        if ids and (terms + len(r["weights"])) * (len(ids) + 1) > CELLS:
            yield ids, weights, idx.documents, idx.length
            ids, weights, terms = [], [], 0
        ids.append(r["item"])
        weights.append([(bytes(t["term"]), t["w"]) for t in r["weights"]])
        terms += len(r["weights"])
    if ids:
        yield ids, weights, idx.documents, idx.length


def highest(rows: DataFrame, block, most: int) -> DataFrame:
    """(q, row) of the ``most`` highest bounds of each item; stored."""
    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b = Block(*block.value)
        best, who = np.zeros((0, len(b.items)), np.float32), np.zeros((0, len(b.items)), np.int64)
        for batch in batches:
            row = batch["row"].to_numpy(np.int64)
            for at, bound in b.bounds(batch["n"].to_numpy(np.int64), list(batch["sketch"])):
                best, who = np.concatenate([best, bound]), np.concatenate([who, np.broadcast_to(row[at][:, None], bound.shape)])
                if len(best) > most:
                    top = np.argpartition(-best, most - 1, axis=0)[:most]
                    best, who = np.take_along_axis(best, top, 0), np.take_along_axis(who, top, 0)
        yield pd.DataFrame({"q": np.tile(np.arange(len(b.items)), len(best)), "row": who.ravel(), "bound": best.ravel()})

    order = Window.partitionBy("q").orderBy(F.desc("bound"), "row")
    found = rows.select("row", "n", "sketch").mapInPandas(look, "q int, row long, bound float").where("bound > 0")
    return stored(found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).select("q", "row"))


def thresholds(rows: DataFrame, block, k: int, probe: int) -> np.ndarray:
    """For each item of the block, the k-th exact score of the ``probe`` x k documents of highest bounds (0 if fewer): no more than the true k-th score."""
    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b = Block(*block.value)
        for batch in batches:
            tfs = list(map(Counter, map(terms_of, batch["text"])))
            yield pd.DataFrame([(q, b.score(q, tf, b.norm(n))) for qs, n, tf in zip(batch["qs"], batch["n"].tolist(), tfs) for q in qs], columns=["q", "score"])

    wanted = highest(rows, block, probe * k).groupBy("row").agg(F.collect_list("q").alias("qs"))
    scores = rows.select("row", "text", "n").join(wanted, "row").select("text", "n", "qs").mapInPandas(judge, "q int, score long")
    order = Window.partitionBy("q").orderBy(F.desc("score"))
    out = np.zeros(len(block.value[0]), np.int64)
    for r in scores.withColumn("r", F.row_number().over(order)).where(F.col("r") == k).collect():  # a number for each item of the block
        out[r["q"]] = r["score"]
    return out


def best(rows: DataFrame, block, least: np.ndarray, k: int) -> DataFrame:
    """(item, score, doc_id, v): in each task the k best documents of each item that reach ``least``; stored."""
    kind = dict(rows.dtypes)["doc_id"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b = Block(*block.value)
        limit = np.maximum(least, 1)
        found: list[list] = [[] for _ in b.items]

        def cut(q: int) -> None:
            found[q].sort(key=lambda x: (-x[0], x[1] is None, x[1], x[2]))
            del found[q][k:]
            if len(found[q]) == k:
                limit[q] = max(limit[q], found[q][-1][0])

        for batch in batches:
            n, text = batch["n"].to_numpy(np.int64), batch["text"]
            ids = [None if x is None or x != x else x for x in batch["doc_id"].tolist()]
            v, norms = batch["v"].tolist(), b.norm(n).tolist()
            for at, bound in b.bounds(n, list(batch["sketch"])):
                known: dict[int, Counter] = {}
                for q in np.flatnonzero((bound >= limit).any(0)).tolist():
                    order = np.argsort(-bound[:, q], kind="stable")
                    for i in order.tolist():
                        if bound[i, q] < limit[q]:
                            break
                        j = int(at[i])
                        if j not in known:
                            known[j] = Counter(terms_of(text.iloc[j]))
                        score = b.score(q, known[j], norms[j])
                        if score >= limit[q]:
                            found[q].append((score, ids[j], v[j]))
                            if len(found[q]) >= 2 * k:
                                cut(q)
        for q in range(len(b.items)):
            cut(q)
        out = [(b.items[q], *x) for q, some in enumerate(found) for x in some]
        yield pd.DataFrame({"item": [x[0] for x in out], "score": [x[1] for x in out], "doc_id": pd.Series([x[2] for x in out], dtype=object), "v": [x[3] for x in out]})

    return rows.select("doc_id", "v", "text", "n", "sketch").mapInPandas(scan, f"item long, score long, doc_id {kind}, v long")


def search(idx: Index, items: DataFrame, k: int = 50, probe: int = 2) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 for each row of ``items``."""
    spark = idx.rows.sparkSession
    asked = weighed(items, idx)
    found = []
    for one in blocks(asked, idx):
        block = spark.sparkContext.broadcast(one)
        found.append(write(best(idx.rows, block, thresholds(idx.rows, block, k, probe), k)))
    kind = f"item long, score long, doc_id {dict(idx.rows.dtypes)['doc_id']}, v long"
    hits = spark.read.schema(kind).parquet(*found) if found else spark.createDataFrame([], kind)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), F.asc_nulls_last("v"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


_TERMS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op13_lexical_search", rf"""
WITH d AS (SELECT r, doc_id, w, len(w) AS n FROM (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format('text')} AS w FROM documents) WHERE len(w) > 0),
s AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM d),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY ALL),
i AS (SELECT DISTINCT q, item_id, unnest(w) AS t FROM (SELECT row_number() OVER () AS q, item_id, {_TERMS.format('text')} AS w FROM benchmark)),
f AS (SELECT t, floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s WHERE t IN (SELECT t FROM i) GROUP BY t),
scored AS (SELECT q, item_id, r, doc_id, sum(f.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // l))))::BIGINT AS score
  FROM i JOIN f USING (t) JOIN p USING (t) JOIN d USING (r), s GROUP BY q, item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
""")
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark")).withColumn("rank", F.col("rank").cast("int"))
