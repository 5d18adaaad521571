"""Exact top-k search over binary codes by incremental multi-index hashing.

Codes are cut into segments of 16 bits, and each block of rows has a table for each segment. For a query,
the search radius grows one segment at a time: after radius r in the segments up to s and r - 1 in the
others, every code within ``segments * r + s`` bits of the query has been met in some table. Each code met
is verified on its whole length; the search ends when the kth verified distance is covered, so the answer
is exact.

Rows with one code give the same distances, so only the ``k`` smallest ids of each code go into a block
(Spark limits those groups before it shuffles them), and equal queries are searched once. Blocks hold at
most about ``rows`` rows and ``queries`` queries; every block of queries meets every block of rows, and
each pair is one group.

Rows without id, without vector or with a vector of other length are left out; null elements count as
not positive; repeated rows count once. Equal distances are ordered by id. A query finds itself too.
Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hangarflow.llm.common import pick, query, stored, table

_POPCOUNT = np.bitwise_count(np.arange(1 << 16, dtype=np.uint16))
#: 16-bit masks with r bits, for each r.
MASKS = [np.flatnonzero(_POPCOUNT == r) for r in range(17)]


def binarize(vector: Column, dims: int) -> Column:
    """One bit for each dimension (1: positive), packed; null for a vector of other length. ``dims`` is a multiple of 16."""

    @F.pandas_udf("binary")
    def pack(vectors: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else np.packbits(np.asarray(v, float) > 0).tobytes() for v in vectors], dtype=object)

    return F.when(F.size(vector) == dims, pack(F.when(F.size(vector) == dims, vector)))


def search_block(codes: np.ndarray, ids: np.ndarray, wanted: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, distances) of the k nearest rows for each query, by distance and id. codes, wanted: a row of 16-bit segments each."""
    n, m = codes.shape
    tables = []
    for s in range(m):
        order = np.argsort(codes[:, s], kind="stable")
        tables.append((order, np.searchsorted(codes[order, s], np.arange((1 << 16) + 1))))
    met, out = np.full(n, -1), []
    for q, code in enumerate(wanted):
        found, dist, kth = [], [], None
        for r, masks in enumerate(MASKS):
            for s in range(m):
                order, starts = tables[s]
                values = masks ^ int(code[s])
                low, many = starts[values], starts[values + 1] - starts[values]
                low, many = low[many > 0], many[many > 0]
                at = order[np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())] if len(many) else order[:0]
                at = at[met[at] != q]
                if len(at):
                    met[at] = q
                    found.append(at)
                    dist.append(np.bitwise_count(codes[at] ^ code).sum(1).astype(np.int64))
                    every = np.concatenate(dist)
                    kth = np.partition(every, k - 1)[k - 1] if len(every) >= k else None
                if kth is not None and kth <= m * r + s:
                    break
            else:
                continue
            break
        at, d = (np.concatenate(found), np.concatenate(dist)) if found else (np.arange(0), np.arange(0))
        best = np.lexsort((ids[at], d))[:k]
        out.append((at[best], d[best]))
    return out


def nearest(rows: DataFrame, wanted: DataFrame, k: int = 10, rows_per_block: int = 65_536, queries_per_block: int = 4_096) -> DataFrame:
    """(query_id, rank, id, distance) for all of ``wanted`` (id, code) against all ``rows`` (id, code)."""
    by_code = Window.partitionBy("code").orderBy("id")
    kept = stored(rows.where("id IS NOT NULL AND code IS NOT NULL").distinct().withColumn("n", F.row_number().over(by_code)).where(F.col("n") <= k).select("id", "code"))
    asked = stored(wanted.where("id IS NOT NULL AND code IS NOT NULL").distinct())
    codes = asked.select("code").distinct()
    blocks = max(1, -(-kept.count() // rows_per_block))
    parts = max(1, -(-codes.count() // queries_per_block))
    block, part = F.pmod(F.xxhash64("code", "id"), F.lit(blocks)), F.pmod(F.xxhash64("code"), F.lit(parts))
    grid = kept.select("id", "code", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")).union(
        codes.select(F.lit(None).cast("long"), "code", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), part))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        own, other = group[group["id"].notna()], group[group["id"].isna()]
        if not len(own) or not len(other):
            return pd.DataFrame({"code": [], "id": [], "distance": []})
        split = lambda f: np.frombuffer(b"".join(f["code"]), np.uint16).reshape(len(f), -1)
        ids = own["id"].to_numpy(np.int64)
        hits = search_block(split(own), ids, split(other), k)
        return pd.DataFrame({
            "code": np.repeat(np.array(list(other["code"]), object), [len(a) for a, _ in hits]),
            "id": ids[np.concatenate([a for a, _ in hits])], "distance": np.concatenate([d for _, d in hits])})

    local = grid.repartition(F.col("block"), F.col("part")).groupBy("block", "part").applyInPandas(search, "code binary, id long, distance long")
    rank = F.row_number().over(Window.partitionBy("code").orderBy("distance", "id"))
    best = local.withColumn("rank", rank).where(F.col("rank") <= k)
    return asked.select(F.col("id").alias("query_id"), "code").join(best, "code").select("query_id", F.col("rank").cast("long"), "id", "distance")


@query("op1_hamming_topk", """
WITH c AS (SELECT DISTINCT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS code
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) = 64),
d AS (SELECT q.vec_id AS query_id, r.vec_id, hamming(q.code, r.code)::BIGINT AS distance FROM c q, c r WHERE q.vec_id % 20 = 0)
SELECT query_id, rank, vec_id, distance FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d) WHERE rank <= 10
""")
def op1_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = pick(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    codes = stored(vectors.select(F.col("vec_id").alias("id"), binarize(F.col("embedding"), 64).alias("code")))
    return nearest(codes, codes.where("id % 20 = 0")).withColumnRenamed("id", "vec_id")
