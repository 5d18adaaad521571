"""Suffix dedup: removal of byte strings of ``length`` bytes that stand in more than one place.

The order of suffixes is needed up to ``length`` bytes only: two places repeat each other exactly if they
fall together in it, and the place before (after) in that run of the order is the previous (next) one in
text order, which says whether an earlier (later) copy exists. The order is never built over all bytes.

1. Every ``length``-byte window has a smallest hash among its grams of ``gram`` bytes. Equal windows
   have the same, so windows are dealt by it. Neighbouring windows with one such gram form a block, about one
   for each 100 bytes.
2. Blocks are counted by content. A block that stands twice repeats in all its windows, without
   looking at any of them. A block whose gram stands nowhere else has no repeat at all.
3. Only the others (some windows repeat, others don't) are compared window by window: the blocks of one
   gram meet in a task, their windows are put in suffix order and the neighbours in it compared. Grams
   with more than ``in_task`` different blocks are dealt by window instead, so that no task
   holds a hot gram; both ways are exact.

Windows are compared by hashes of 64 bits within the windows of one 64-bit gram hash.

A null text is empty. Rows with the same id and text are copies of each other like any other documents.
Texts shorter than ``length`` keep all bytes. Extra columns are ignored. With ``keep_first`` the first copy,
by id and place, stays; else every copy goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from hangarflow.llm.common import pick, query, stored, table, text_or_empty

LENGTH, GRAM, IN_TASK = 400, 200, 4_096
_BASE = 0x9E3779B97F4A7C15
_LETTERS = np.random.default_rng(3).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Hashes of all windows of a text; powers are kept for the longest text so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, raw: np.ndarray, width: int) -> np.ndarray:
        n = len(raw)
        if n + 1 > len(self.up):
            self.up, self.down = powers(_BASE, 2 * n + 1), powers(pow(_BASE, -1, 2**64), 2 * n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LETTERS[raw] * self.up[:n], out=sums[1:])
        h = (sums[width:] - sums[:-width]) * self.down[:n - width + 1]
        for _ in range(2):
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, from running minima within blocks of that width."""
    n = len(h) - width + 1
    rows = np.concatenate([h, np.full(-len(h) % width, 2**64 - 1, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(ahead[:n], np.minimum.accumulate(rows, 1).ravel()[width - 1:width - 1 + n])


def blocks(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, v, m, h, s, n, twice): blocks of n windows from s on with least gram m and content h; twice: m stands in it twice."""
    rows = pick(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("v"), "text").where(F.octet_length("text") >= length)
    kind = f"doc_id {dict(rows.dtypes)['doc_id']}, v long, m array<long>, h array<long>, s array<int>, n array<int>, twice array<boolean>"
    grams = length - gram + 1

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        rolling = Rolling()
        for batch in batches:
            out = []
            for text in batch["text"]:
                data = text.encode("utf-8", "surrogatepass")
                g = rolling(np.frombuffer(data, np.uint8), gram)
                m = sliding_min(g, grams)
                s = np.concatenate([[0], np.flatnonzero(m[1:] != m[:-1]) + 1])
                e = np.append(s[1:], len(m))
                ends = (e + length - 1).tolist()
                h = np.array([xxhash.xxh3_64_intdigest(data[i:j]) for i, j in zip(s.tolist(), ends)], np.uint64)
                twice = np.zeros(len(s), bool)
                order = np.sort(g)
                if (order[1:] == order[:-1]).any():
                    twice[:] = [(g[i:j + grams - 1] == m[i]).sum() > 1 for i, j in zip(s.tolist(), e.tolist())]
                out.append((m[s].view(np.int64), h.view(np.int64), s.astype(np.int32), (e - s).astype(np.int32), twice))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "v": batch["v"], **{c: [o[i] for o in out] for i, c in enumerate(("m", "h", "s", "n", "twice"))}})

    lists = stored(rows.mapInPandas(cut, kind))
    return lists.select("doc_id", "v", F.explode(F.arrays_zip("m", "h", "s", "n", "twice")).alias("b")).select("doc_id", "v", "b.*")


def compared(parts: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """(doc_id, v, start, end) of repeated windows of blocks (m, doc_id, v, s, content), the blocks of one gram in one task."""
    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rolling, rest = Rolling(), None
        for batch in _with_end(batches):
            if batch is not None:
                rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
                open_gram = rest["m"] == rest["m"].iloc[-1]
                done, rest = rest[~open_gram], rest[open_gram]
            else:
                done, rest = rest, None
            if done is not None and len(done):
                yield spans(done, rolling)

    def spans(done: pd.DataFrame, rolling: Rolling) -> pd.DataFrame:
        done = done.sort_values(["doc_id", "v", "s"], ignore_index=True)
        hashes = [rolling(np.frombuffer(c, np.uint8), length) for c in done["content"]]
        sizes = np.array([len(h) for h in hashes])
        block = np.repeat(np.arange(len(done)), sizes)
        offset = np.arange(len(block)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        grams = done["m"].to_numpy(np.int64).view(np.uint64)
        key = np.concatenate(hashes) ^ (grams * np.uint64(_BASE))[block]
        order = np.argsort(key, kind="stable")  # suffix order up to ``length``; equal ones in text order
        same = key[order][1:] == key[order][:-1]
        repeated = np.zeros(len(key), bool)
        repeated[order[1:][same]] = True
        if not keep_first:
            repeated[order[:-1][same]] = True
        at = np.flatnonzero(repeated)
        new = np.ones(len(at), bool)
        new[1:] = (block[at][1:] != block[at][:-1]) | (offset[at][1:] != offset[at][:-1] + 1)
        first, last = at[new], at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] if len(at) else at
        b, s = block[first], done["s"].to_numpy(np.int64)
        return pd.DataFrame({"doc_id": done["doc_id"].to_numpy()[b], "v": done["v"].to_numpy()[b], "start": s[b] + offset[first], "end": s[b] + offset[last] + length})

    kind = f"doc_id {dict(parts.dtypes)['doc_id']}, v long, start int, end int"
    return parts.repartition("m").sortWithinPartitions("m").mapInPandas(judge, kind)


def _with_end(batches):
    yield from (b for b in batches if len(b))
    yield None


def dealt_by_window(parts: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """The same as ``compared``, a row for each window."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rolling = Rolling()
        for batch in batches:
            for m, doc, v, s, content in zip(*(batch[c] for c in ("m", "doc_id", "v", "s", "content"))):
                w = rolling(np.frombuffer(content, np.uint8), length)
                yield pd.DataFrame({"m": m, "w": w.view(np.int64), "doc_id": doc, "v": v, "start": s + np.arange(len(w))})

    windows = stored(parts.mapInPandas(cut, f"m long, w long, doc_id {dict(parts.dtypes)['doc_id']}, v long, start int"))
    many = windows.groupBy("m", "w").agg(F.count(F.lit(1)).alias("many"), F.min(F.struct("doc_id", "v", "start")).alias("first")).where("many > 1")
    hit = windows.join(many, ["m", "w"])
    if keep_first:
        hit = hit.where(~F.struct("doc_id", "v", "start").eqNullSafe(F.col("first")))
    return hit.select("doc_id", "v", "start", (F.col("start") + length).alias("end"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_first: bool = False, in_task: int = IN_TASK) -> DataFrame:
    """(doc_id, v, start, end) in bytes; the spans overlap and cover what goes. v is xxhash64 of the text."""
    cut = blocks(docs, length, gram)
    counts = cut.groupBy("m", "h").agg(F.count(F.lit(1)).alias("same"), F.max("twice").alias("twice"))
    per = counts.groupBy("m").agg(F.sum("same").alias("all"), F.count(F.lit(1)).alias("kinds"), F.max("twice").alias("any_twice"), F.min("same").alias("rarest"))
    per = per.where("all > 1 OR any_twice").select("m", "kinds", "any_twice", "rarest")
    some = counts.select("m", "h", "same").join(per, "m")
    hits = stored(cut.join(some, ["m", "h"]).drop("twice"))
    # Whole blocks: every copy, or every copy but the first.
    whole = hits.where("same > 1")
    first = whole.groupBy("m", "h").agg(F.min(F.struct("doc_id", "v", "s")).alias("first"))
    spans = lambda df: df.select("doc_id", "v", F.col("s").alias("start"), (F.col("s") + F.col("n") + (length - 1)).alias("end"))
    sure = spans(whole) if not keep_first else spans(whole.join(first, ["m", "h"]).where(~F.struct("doc_id", "v", "s").eqNullSafe(F.col("first"))))
    # Blocks to look into: single ones, and one of each kind that may repeat a part of them.
    mixed = "kinds > 1 OR any_twice" if keep_first else "rarest = 1 AND (kinds > 1 OR any_twice)"
    chosen = whole.where(mixed).join(first, ["m", "h"]).where(F.struct("doc_id", "v", "s").eqNullSafe(F.col("first"))).drop("first").dropDuplicates(["m", "h"])
    look = hits.where("same = 1").unionByName(chosen)
    look = look.groupBy(F.col("doc_id").alias("d"), F.col("v").alias("w")).agg(F.collect_list(F.struct("m", "s", "n", "kinds")).alias("b"))
    texts = pick(docs, "doc_id", "text").withColumn("v", F.xxhash64("text"))
    got = texts.join(look, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("v") == F.col("w"))).dropDuplicates(["doc_id", "v"])
    raw = F.col("text").cast("binary")
    got = got.select("doc_id", "v", raw.alias("raw"), F.explode("b").alias("b")).select(
        "doc_id", "v", "b.m", "b.s", "b.kinds", F.substring("raw", F.col("b.s") + 1, F.col("b.n") + (length - 1)).alias("content"))
    parts = stored(got)
    small, large = (parts.where(c).select("m", "doc_id", "v", "s", "content") for c in (f"kinds <= {in_task}", f"kinds > {in_task}"))
    return sure.union(compared(small, length, keep_first)).union(dealt_by_window(large, length, keep_first))


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): spans are the maximal runs of bytes that go (start, end), kept the bytes that stay."""
    spans = repeated_spans(docs, **options)
    spans = spans.distinct().groupBy(F.col("doc_id").alias("d"), F.col("v").alias("w")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    rows = pick(docs, "doc_id", "text").withColumn("v", F.xxhash64("text"))
    rows = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("v") == F.col("w")), "left").select("doc_id", text_or_empty().cast("binary").alias("raw"), "spans")

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, all_runs, kept = [], [], []
            for raw, spans in zip(batch["raw"], batch["spans"]):
                runs: list[list[int]] = []
                for s in spans if spans is not None else ():
                    if runs and s["start"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s["end"])
                    else:
                        runs.append([s["start"], s["end"]])
                edges = [0, *(x for r in runs for x in r), len(raw)]
                sizes.append(len(raw))
                all_runs.append([{"start": a, "end": b} for a, b in runs])
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": sizes, "spans": all_runs, "kept": kept})

    return rows.mapInPandas(merge, f"doc_id {dict(rows.dtypes)['doc_id']}, n_bytes long, spans array<struct<start: int, end: int>>, kept binary")


@query("op3_long_repeats", rf"""
WITH b AS (SELECT row_number() OVER () AS r, doc_id, hex(coalesce(text, '')) AS x FROM documents),
w AS (SELECT r, i, md5(substr(x, 2 * i + 1, {2 * LENGTH})) AS w FROM b, unnest(range(0, len(x) // 2 - {LENGTH - 1})) AS u(i) WHERE len(x) >= {2 * LENGTH}),
hit AS (SELECT r, i FROM w WHERE w IN (SELECT w FROM w GROUP BY w HAVING count(*) > 1)),
marked AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {LENGTH} THEN 0 ELSE 1 END AS new FROM hit),
runs AS (SELECT r, min(i) AS s, max(i) + {LENGTH} AS e FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM marked) GROUP BY r, g),
gone AS (SELECT r, sum(e - s) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r),
edges AS (SELECT r, s, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS before, lead(s) OVER (PARTITION BY r ORDER BY s) AS next FROM runs),
kept AS (SELECT r, string_agg(substr(x, 2 * before + 1, 2 * (s - before)) || CASE WHEN next IS NULL THEN substr(x, 2 * e + 1) ELSE '' END, '' ORDER BY s) AS k FROM edges JOIN b USING (r) GROUP BY r)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k, x))) AS kept_sha256
FROM b LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
""")
def op3_long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
