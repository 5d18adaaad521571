"""Phrase collocations by vertical partitioning of a depth-truncated suffix forest.

Texts are cut into pieces and words; a phrase is a run of words inside a piece, and every place where one
starts is a suffix, cut off after ``longest`` words. The suffixes fall into groups by their first words: by
the first word alone, or, as long as more than ``budget`` suffixes share a prefix, by one word more. The counts
that this needs are taken prefix length by prefix length, each time for extensions of the prefixes over budget only. So a
group holds about ``budget`` suffixes, whatever the frequency of its words, and each group builds its subtrees by itself: its
suffixes sorted, a node is a run of equal prefixes and its frequency the sum of its leaves.

A word is a 64-bit code of language and word; two words with one code are noticed in the table of all words, and
another seed is taken. A suffix ends before a word that occurs less than ``least`` times, for no phrase with
it is frequent. Which words those are is kept as one mark for each of 2**22 ranges of codes, whatever the
corpus; a rare word in the range of a frequent one costs space only. Prefixes over budget are sent to all tasks; as a prefix
takes more than ``budget`` suffixes, and the budget grows when there are more than 2**20 such shares, they are 2**20 at most
for each length. Each task first counts equal suffixes of its own, so very frequent phrases arrive as a row from each. Suffixes travel in
blocks, in order and compressed; words are written as their rank among the 2**20 most frequent ones, others
as their code, once for each block.

A phrase of two words or more that is frequent is a candidate. Each cut in two gives 1000 * a * n / (l * r), rounded down,
in decimals of 38 digits; the lowest counts, the first of equal ones. A candidate inside a longer one that is
``percent`` per cent as frequent or more is dropped; it is enough to look at those longer by one word, since frequencies
fall with length.

Null and empty texts have no words; a null lang is ``und``. Every row is a document, repeated ones too, and ids play no
part. Extra columns are ignored. An empty table gives no rows. Phrases of equal score and frequency rank by UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hangarflow.llm.common import LOWER, UPPER, pick, query, stored, table

BREAKS = ".,;:!?\n\x0b\x0c\r"
FOLD = bytes.maketrans((UPPER + "\t" + BREAKS).encode(), (LOWER + " " + "\n" * len(BREAKS)).encode())
LONGEST, LEAST, TOP, BUDGET = 5, 100, 2000, 1 << 20
#: Words that a task encodes before it hands them on, and distinct ones it remembers; marks of frequent words; words sent as ranks.
CHUNK, KNOWN, MARKS, RANKS = 1 << 21, 1 << 19, 1 << 22, 1 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


class Numbers(dict):
    """A number for each word, in order of appearance; a line's end is 0, the empty word 1."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def split(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case, with a line's end between pieces and at the end; empty words among them."""
    return ((text or "") + "\n").encode("utf-8", "surrogatepass").translate(FOLD).replace(b"\n", b" \n ").split(b" ")


def encoded(docs: DataFrame, seed: int) -> DataFrame:
    """Rows (lang, word, code, n) of words and rows (codes, body) of chunks of text; stored."""
    own = pick(docs, "lang", "text").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    names = ["lang", "word", "code", "n", "codes", "body"]
    kinds = [pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def rows(size: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(size, t)) for c, t in zip(names, kinds)], names)

    class Lang:
        """The words of one language in a task."""

        def __init__(self, lang: str):
            self.lang, self.head = lang, lang.encode("utf-8", "surrogatepass") + b"\n"
            self.parts, self.many = [], 0
            self.forget()

        def forget(self) -> None:
            self.numbers, self.codes, self.counts = Numbers(), np.zeros(2, np.uint64), np.zeros(2, np.int64)

        def chunk(self) -> pa.RecordBatch:
            import xxhash
            import zstandard

            ids = np.concatenate(self.parts)
            ids, self.parts, self.many = ids[ids != 1], [], 0
            new = list(islice(self.numbers, len(self.codes), None))
            codes = np.fromiter((xxhash.xxh3_64_intdigest(self.head + w, seed) | 1 for w in new), np.uint64, len(new))
            self.codes = np.concatenate([self.codes, codes])
            self.counts = np.concatenate([self.counts, np.zeros(len(new), np.int64)]) + np.bincount(ids, minlength=len(self.codes))
            used, local = np.unique(np.concatenate([np.zeros(1, ids.dtype), ids]), return_inverse=True)
            body = zstandard.compress(local[1:].astype(np.int32).tobytes(), 1)
            return rows(1, codes=pa.array([self.codes[used[1:]].tobytes()], pa.binary()), body=pa.array([body], pa.binary()))

        def words(self) -> pa.RecordBatch:
            """The words so far; call after ``chunk``."""
            some = list(islice(self.numbers, 2, None))
            out = rows(len(some), lang=pa.array([self.lang] * len(some), pa.string()), word=pa.array(some, pa.binary()),
                       code=pa.array(self.codes[2:].view(np.int64)), n=pa.array(self.counts[2:]))
            self.forget()
            return out

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Lang] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                own = held.get(lang) or held.setdefault(lang, Lang(lang))
                words = split(text.as_py())
                own.parts.append(np.fromiter(map(own.numbers.__getitem__, words), np.int32, len(words)))
                own.many += len(words)
                if own.many >= CHUNK:
                    yield own.chunk()
                    if len(own.numbers) >= KNOWN:
                        yield own.words()
        for own in held.values():
            if own.parts:
                yield own.chunk()
            yield own.words()

    return stored(own.mapInArrow(encode, "lang string, word binary, code long, n long, codes binary, body binary"))


def vocabulary(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, word, code, f) of all words and the chunks (codes, body), with codes of which no two words share one."""
    seed = 0
    while True:
        made = encoded(docs, seed)
        words = stored(made.where("word IS NOT NULL").groupBy("lang", "word", "code").agg(F.sum("n").alias("f")))
        if words.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            return words, made.where("body IS NOT NULL").select("codes", "body")
        seed += 1


def marks(frequent: DataFrame) -> np.ndarray:
    """MARKS booleans, whatever the corpus: whether a frequent word has a code of the range."""
    out = np.zeros(MARKS, bool)
    shift = 65 - MARKS.bit_length()
    out[frequent.select(F.shiftrightunsigned("code", shift).alias("at")).distinct().toPandas()["at"].to_numpy(np.int64)] = True
    return out


def suffixes(codes: bytes, body: bytes, frequent: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own, rows, n): the codes of one chunk, its distinct suffixes of two words or more, in order, as places in ``own`` (0 after the end), and how often each occurs."""
    import zstandard

    own = np.concatenate([np.zeros(1, np.uint64), np.frombuffer(codes, np.uint64)])
    good = frequent[(own >> np.uint64(65 - MARKS.bit_length())).astype(np.int64)]
    good[0] = False
    ids = np.frombuffer(zstandard.decompress(body), np.int32)
    ids = np.concatenate([np.where(good[ids], ids, 0), np.zeros(longest, np.int32)])
    starts = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    at = np.zeros((longest, len(starts)), np.int64)
    alive = np.ones(len(starts), bool)
    for d in range(longest):
        word = ids[starts + d]
        alive &= word > 0
        at[d] = np.where(alive, word, 0)
    # Two numbers in one key, to sort by fewer.
    keys = [at[d] << 31 | at[d + 1] if d + 1 < longest else at[d] for d in range(0, longest, 2)]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= np.diff(key[order]) != 0
    first = np.flatnonzero(new)
    return own, at[:, order[first]], np.diff(np.append(first, len(order)))


def packed(own: np.ndarray, rows: np.ndarray, n: np.ndarray, ranks: tuple[np.ndarray, np.ndarray]) -> bytes:
    """Suffixes (places in ``own``) and their counts as bytes; ``ranks``: the codes sent as ranks, in order, and their ranks from 1."""
    import zstandard

    known, rank = ranks
    used, local = np.unique(rows, return_inverse=True)
    codes = own[used]
    at = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
    ranked = known[at] == codes if len(known) else np.zeros(len(codes), bool)
    others = codes[~ranked & (codes > 0)]
    number = np.zeros(len(used), np.uint32)
    number[ranked] = rank[at[ranked]]
    number[~ranked & (codes > 0)] = RANKS + 1 + np.arange(len(others))
    # Bytes of one weight together: the high ones are few, and small counts are alike.
    planes = np.concatenate([number[local].ravel(), n.astype(np.uint32)]).view(np.uint8).reshape(-1, 4).T
    return len(others).to_bytes(4, "little") + others.tobytes() + zstandard.compress(np.ascontiguousarray(planes).tobytes(), 3)


def unpacked(body: bytes, longest: int, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of codes, counts) of ``packed``; ``top`` has the code of each rank, 0 first."""
    import zstandard

    many = int.from_bytes(body[:4], "little")
    others = np.frombuffer(body[4:4 + 8 * many], np.uint64)
    planes = np.frombuffer(zstandard.decompress(body[4 + 8 * many:]), np.uint8).reshape(4, -1)
    flat = np.ascontiguousarray(planes.T).view(np.uint32).reshape(longest + 1, -1).astype(np.int64)
    number, codes = flat[:-1], np.zeros(flat[:-1].shape, np.uint64)
    ranked = number <= RANKS
    codes[ranked], codes[~ranked] = top[number[ranked]], others[number[~ranked] - RANKS - 1]
    return codes, flat[-1]


def prefix(rows: np.ndarray, d: int) -> np.ndarray:
    """A hash of the first d codes of each suffix."""
    out = rows[0]
    for k in range(1, d):
        out = (out * MIX ^ (out >> np.uint64(29))) * MIX + rows[k]
    return out


def over_budget(chunks: DataFrame, words: DataFrame, frequent, budget: int, longest: int) -> list[np.ndarray]:
    """By length, the hashes of the prefixes that more than ``budget`` suffixes have, in order; the prefix of a prefix is one too."""
    sc = chunks.sparkSession.sparkContext
    top = words.where(F.col("f") > budget).select("code").toPandas()["code"].to_numpy(np.int64).view(np.uint64)
    out = [np.sort(top)]
    while len(out[-1]) and len(out) < longest - 1:
        known, d = sc.broadcast(out[-1]), len(out) + 1

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for codes, body in zip(batch["codes"], batch["body"]):
                    own, rows, n = suffixes(codes, body, frequent.value, longest)
                    rows = own[rows]
                    some = np.isin(prefix(rows, d - 1), known.value)
                    h, at = np.unique(prefix(rows[:, some], d), return_inverse=True)
                    yield pd.DataFrame({"h": h.view(np.int64), "n": np.bincount(at, n[some], len(h)).astype(np.int64)})

        more = chunks.mapInPandas(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > budget)
        out.append(np.sort(more.select("h").toPandas()["h"].to_numpy(np.int64).view(np.uint64)))
    return out


def phrases(chunks: DataFrame, words: DataFrame, total: int, longest: int = LONGEST, least: int = LEAST, budget: int = BUDGET) -> DataFrame:
    """(w, f): the phrases (arrays of codes) of two words or more that occur ``least`` times, and how often they do."""
    sc = chunks.sparkSession.sparkContext
    budget = max(budget, total >> 20)
    frequent = sc.broadcast(marks(words.where(F.col("f") >= least)))
    hot = sc.broadcast(over_budget(chunks, words, frequent, budget, longest))
    most = words.where(F.col("f") >= least).orderBy(F.desc("f"), "code").limit(RANKS).select("code").toPandas()["code"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(most)
    ranks, top = sc.broadcast((most[order], order + 1)), sc.broadcast(np.concatenate([np.zeros(1, np.uint64), most]))
    groups = max(1, -(-total // budget))
    names = [f"w{d}" for d in range(longest)]

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for codes, body in zip(batch["codes"], batch["body"]):
                own, places, n = suffixes(codes, body, frequent.value, longest)
                rows = own[places]
                depth, h = np.ones(len(n), np.int64), rows[0].copy()
                for d, known in enumerate(hot.value, 1):
                    more = (depth == d) & np.isin(prefix(rows, d), known)
                    depth[more] += 1
                    h[more] = prefix(rows[:, more], d + 1)
                group = (h * MIX >> np.uint64(11)).astype(np.int64) % groups
                order = np.lexsort((depth, group))
                edge = np.flatnonzero(np.diff(group[order] * longest + depth[order])) + 1
                out = [(group[some[0]], depth[some[0]], len(some), packed(own, places[:, some], n[some], ranks.value)) for some in np.split(order, edge)] if len(order) else []
                if out:
                    yield pd.DataFrame(out, columns=["g", "depth", "n", "body"])

    def subtrees(batch: pd.DataFrame) -> pd.DataFrame:
        """The nodes of a group's subtrees; those above the group's own prefix are parts of theirs, for other groups have the rest."""
        parts = [unpacked(b, longest, top.value) for b in batch["body"]]
        depth = np.repeat(batch["depth"].to_numpy(np.int64), batch["n"])
        rows, n = np.concatenate([r for r, _ in parts], axis=1), np.concatenate([m for _, m in parts])
        order = np.lexsort(rows[::-1])
        rows, n, depth = rows[:, order], n[order], depth[order]
        new, out = np.zeros(len(n), bool), []
        new[:1] = True
        for d in range(longest):
            new[1:] |= rows[d, 1:] != rows[d, :-1]
            if d:
                first = np.flatnonzero(new)
                f = np.add.reduceat(n, first)
                keep = (rows[d, first] != 0) & ((f >= least) | (depth[first] > d + 1))
                node = np.where(np.arange(longest)[:, None] <= d, rows[:, first[keep]], 0).view(np.int64)
                out.append(pd.DataFrame({**dict(zip(names, node)), "f": f[keep]}))
        return pd.concat(out)

    dealt = chunks.mapInPandas(deal, "g long, depth int, n long, body binary")
    nodes = dealt.groupBy("g").applyInPandas(subtrees, ", ".join(f"{c} long" for c in names) + ", f long")
    whole = nodes.groupBy(*names).agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return stored(whole.select(F.array_remove(F.array(*names), F.lit(0).cast("long")).alias("w"), "f"))


def part(w: str, first: int | Column, length: int | Column) -> Column:
    return F.slice(w, first, length)


def scored(found: DataFrame, counts: DataFrame, totals: DataFrame, words: DataFrame, percent: int = 100) -> DataFrame:
    """(lang, w, a, l, r, n, score) of the candidates that stay; ``counts`` (w, f) has the single words besides."""
    inner = found.where(F.size("w") > 2).select("f", F.explode(F.array(part("w", F.lit(1), F.size("w") - 1), part("w", F.lit(2), F.size("w") - 1))).alias("w"))
    inner = inner.groupBy("w").agg(F.max("f").alias("longer"))
    alone = found.join(inner, "w", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("f"))).select("w", F.col("f").alias("a"))
    lang = words.select(F.col("code").alias("c"), "lang")
    owned = alone.withColumn("c", F.get("w", F.lit(0))).join(lang, "c").join(totals, "lang").select("lang", "w", "a", "n")
    cuts = owned.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cuts = cuts.withColumn("lw", part("w", F.lit(1), F.col("k"))).withColumn("rw", part("w", F.col("k") + 1, F.size("w") - F.col("k")))
    cuts = cuts.join(counts.select(F.col("w").alias("lw"), F.col("f").alias("l")), "lw").join(counts.select(F.col("w").alias("rw"), F.col("f").alias("r")), "rw")
    score = F.expr("(cast(1000 * a AS decimal(19, 0)) * cast(n AS decimal(18, 0))) div (cast(l AS decimal(19, 0)) * cast(r AS decimal(18, 0)))")
    lowest = cuts.withColumn("score", score).groupBy("lang", "w", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    return lowest.select("lang", "w", "a", "m.l", "m.r", "n", "m.score")


def ranked(rows: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each lang, with rank and phrase; phrases are spelled out for rows that may be among them only."""
    own = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = rows.withColumn("place", F.rank().over(own)).where(F.col("place") <= top).drop("place")
    spelled = near.select("*", F.posexplode("w").alias("at", "code")).join(words.select("code", F.col("word").cast("string").alias("word")), "code")
    whole = spelled.groupBy("lang", "w", "a", "l", "r", "n", "score").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("s"))
    whole = whole.withColumn("phrase", F.array_join(F.transform("s", lambda x: x["word"]), " "))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    return whole.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, percent: int = 100, top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``longest`` words of each lang."""
    words, chunks = vocabulary(docs)
    totals = stored(words.groupBy("lang").agg(F.sum("f").alias("n")))
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    found = phrases(chunks, words, total, longest, least, budget)
    frequent = words.where(F.col("f") >= least)
    counts = found.union(frequent.select(F.array("code"), "f"))
    return ranked(stored(scored(found, counts, totals, frequent, percent)), frequent, top)


@query("op11_collocations", r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, d, i AS p, list_filter(regexp_split_to_array(s[i], '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, row_number() OVER () AS d, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS s FROM documents),
  unnest(range(1, len(s) + 1)) AS u(i)),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS t FROM p, unnest(range(1, 6)) AS a(k), unnest(range(1, len(w) - k + 2)) AS b(i)),
f AS MATERIALIZED (SELECT lang, k, t, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
c AS (SELECT lang, k, t, f AS a, string_split(t, ' ') AS w FROM f WHERE k > 1),
inside AS (SELECT DISTINCT lang, array_to_string(w[i:i + m - 1], ' ') AS t, a FROM c, unnest(range(2, 5)) AS x(m), unnest(range(1, len(w) - m + 2)) AS y(i) WHERE m < k),
alone AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM inside x WHERE x.lang = c.lang AND x.t = c.t AND 100 * x.a >= 100 * c.a)),
cut AS (SELECT c.lang, c.t, c.a, i AS place, x.f AS l, y.f AS r, n, ((1000 * c.a)::HUGEINT * n) // (x.f::HUGEINT * y.f) AS score
  FROM alone c, unnest(range(1, k)) AS u(i), f x, f y, n
  WHERE x.lang = c.lang AND x.t = array_to_string(c.w[1:i], ' ') AND y.lang = c.lang AND y.t = array_to_string(c.w[i + 1:], ' ') AND n.lang = c.lang),
low AS (SELECT *, row_number() OVER (PARTITION BY lang, t ORDER BY score, place) AS o FROM cut)
SELECT lang, rank, t AS phrase, a, l, r, n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, t) AS rank FROM low WHERE o = 1) WHERE rank <= 2000
""")
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
