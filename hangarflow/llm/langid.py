"""Language ID by rank-order profiles.

A profile is the list of a language's most frequent n-grams of letters (1 to 3, with word ends), by rank.
A document's own list is compared with each profile: an n-gram costs the difference of its two ranks, or
``top`` where the profile hasn't got it; the profile with the least sum wins. ``score`` is 1 less the
share of the greatest possible sum.

Profiles are learned from a bounded sample: about ``most`` labelled documents of each language, those
with the smallest hash of their id, whole texts. They are ``top`` n-grams for each language, so their
size doesn't depend on the corpus; only they reach the driver.

A text that is null or has no letter is ``und`` with score 0; so is every text when there is no labelled
document. Equal sums go to the language whose name sorts first. Each row, repeated ids and rows too, has
its own answer. Other columns are kept out of the prediction and ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hangarflow.llm.common import pick, query, table

TOP, MOST = 400, 2_000
SCHEMA = "lang_pred string, score double"
_BITS = 21


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def letters() -> np.ndarray:
    """For each code point: its lower case if it is a letter, or else 0."""
    out = np.zeros(0x110000, np.int64)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


def ngrams(text: str, table: np.ndarray) -> np.ndarray:
    """A number for each n-gram of each word: three code points of 21 bits, or a mark and one or two of them."""
    s = np.zeros(len(text) + 2, np.int64)
    s[1:-1] = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    some = s != 0
    s = s[some | np.concatenate([[True], some[:-1]])]
    if len(s) < 2:
        return s[:0]
    a, b = s[:-1], s[1:]
    tri = (a[:-1] << (2 * _BITS)) | (b[:-1] << _BITS) | b[1:]
    one = s[s != 0] | (0x1FFFFF << (2 * _BITS))
    return np.concatenate([one, (a << _BITS) | b | (0x1FFFFE << (2 * _BITS)), tri[b[:-1] != 0]])


def ranked(text: str, table: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams, equal counts by number."""
    grams, n = np.unique(ngrams(text, table), return_counts=True)
    return grams[np.argsort(-n, kind="stable")[:top]]


def learn(docs: DataFrame, train: Column, top: int = TOP, most: int = MOST) -> dict[str, list[int]]:
    """n-grams by rank, for each language."""
    labelled = pick(docs, "doc_id", "text", "lang").where(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = {r["lang"]: most / r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not share:
        return {}
    place = (F.xxhash64("doc_id") / F.lit(2.0**64)) + F.lit(0.5)
    limit = F.element_at(F.create_map(*(F.lit(x) for kv in share.items() for x in kv)), F.col("lang"))
    sample = labelled.where(place <= limit).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = letters()
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                grams, n = np.unique(np.concatenate([ngrams(t, known) for t in texts]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": grams, "n": n})

    totals = sample.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = totals.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= top)
    out: dict[str, list[int]] = {}
    for r in best.orderBy("lang", "rank").collect():
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


def predict(profiles: dict[str, list[int]], top: int = TOP):
    """A column function: text to (lang_pred, score)."""
    names = sorted(profiles)
    every = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
    ranks = np.full((len(names), len(every) + 1), -1, np.int64)
    for i, name in enumerate(names):
        ranks[i, np.searchsorted(every, profiles[name])] = np.arange(len(profiles[name]))

    @F.pandas_udf(SCHEMA)
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = letters()
        for texts in batches:
            langs, scores = [], []
            for text in texts:
                own = ranked(text, known, top) if text and names else every[:0]
                if not len(own):
                    langs.append("und")
                    scores.append(0.0)
                    continue
                at = np.minimum(np.searchsorted(every, own), len(every) - 1)
                theirs = ranks[:, np.where(every[at] == own, at, len(every))]
                cost = np.where(theirs < 0, top, np.abs(theirs - np.arange(len(own)))).sum(1)
                best = int(cost.argmin())
                langs.append(names[best])
                scores.append(float(1 - cost[best] / (top * len(own))))
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return answer


def identify(docs: DataFrame, train: Column | None = None, top: int = TOP, most: int = MOST) -> DataFrame:
    """``docs`` with a last column of (lang_pred, score) named ``_language``; learns from the rows that ``train`` (of doc_id) picks."""
    profiles = learn(docs, ~held_out() if train is None else train, top, most)
    plain = docs.toDF(*(f"_{i}" for i in range(len(docs.columns))))
    out = plain.withColumn("_language", predict(profiles, top)(F.col(f"_{docs.columns.index('text')}")))
    return out.toDF(*docs.columns, "_language")


def reliable(language: str = "_language", least: float = 0.05) -> Column:
    """Whether a text has a language at all: letters, and some likeness to a profile."""
    return (F.col(f"{language}.lang_pred") != "und") & (F.col(f"{language}.score") >= least)


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    return identify(docs).select("doc_id", held_out().alias("held_out"), "_language.lang_pred", "_language.score")
