"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text (``FEATURES``): densities of a fixed lexicon and of words and word stems learned from
labelled rows, how close lexicon words stand to the second person, capitals, punctuation, digits, repeated
letters, obfuscated words, and the length. Learning takes a bounded sample of labelled rows (``most``, by
hash of the id) in two halves by hash of the text, so that copies stay together: each half gets its features
from the words of the other half. Trees learn on three quarters of the rows, isotonic regression on
the rest. The learned word lists are bounded by ``words`` and are all that passes through the driver.

Null and empty texts have all densities 0 and are scored like others. Rows that repeat an id take the
greater label in training; every row has its own score. Labels with null id or class are ignored. Without
any labelled row of both classes the score is the share of toxic rows, or 0. Labels, lang, source and doc_id
are never inputs of a score. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hangarflow.llm.common import pick, query, stored, table

MOST, WORDS, STEM = 30_000, 2_000, 5
# Words that insult or threaten, and second persons, of four languages.
LEXICON = """idiot idiots moron morons stupid dumb clown clowns scum trash garbage worthless pathetic loser losers
disgusting filthy vermin pig pigs freak freaks jerk fool fools hate kill die shut ugly imbecile creep bastard crap damn hell
idiota imbécil estúpido estúpida basura asqueroso inútil cerdo payaso escoria odio cállate
idiote imbécile stupide crétin abruti ordure minable dégoûtant nul clown porc déteste
dumm dummkopf trottel blöd abschaum müll wertlos erbärmlich schwein widerlich hasse vollidiot depp""".split()
SECOND = "you your yours yourself u ur tu te ti tus usted ustedes vosotros vous votre vos toi ton ta tes du dich dir dein deine euch ihr".split()
FEATURES = [
    "lexicon", "learned", "learned_max", "stems", "learned_distinct", "near_second_person", "second_person", "capitals", "punctuation",
    "exclamations", "digits", "repeats", "obfuscated", "log_words", "word_length",
]
SHIFTED = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
EDGES = ".,;:!?\"'()[]{}<>*_-~|&%#"


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def word_list(text: str) -> list[str]:
    return [w for w in (w.strip(EDGES) for w in text.lower().split()) if w]


def plain(word: str) -> str:
    """A word without obfuscation: digits and signs that stand for letters, marks inside, letters repeated."""
    word = "".join(c for c in (SHIFTED.get(c, c) for c in word) if c.isalpha())
    return re.sub(r"(.)\1{2,}", r"\1", word)


def features(text: str, learned: dict[str, float]) -> list[float]:
    """``learned``: weights of words, and of stems under a leading blank."""
    words = word_list(text)
    n, size = max(1, len(words)), max(1, len(text))
    hits, second, odd, weights, stems, last = [], [], 0, [], 0.0, -9
    for i, w in enumerate(words):
        if not w.isalpha():
            odd += any(c.isalpha() for c in w)
            w = plain(w)
        if w in _LEXICON:
            hits.append(i)
        if w in _SECOND:
            second.append(i)
        if w in learned:
            weights.append(learned[w])
        stems += learned.get(" " + w[:STEM], 0.0) if len(w) >= STEM else 0.0
    near = 0
    if hits and second:
        at = np.searchsorted(second, hits)
        both = np.array([-9, *second, len(words) + 9])
        near = int((np.minimum(np.abs(both[at] - hits), np.abs(both[at + 1] - hits)) <= 5).sum())
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(raw, minlength=256)
    punctuation = kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum()
    repeats = int((raw[2:] == raw[1:-1])[(raw[1:-1] == raw[:-2])].sum()) if len(raw) > 2 else 0
    return [
        len(hits) / n, sum(weights) / n, max(weights, default=0.0), stems / n, len(set(weights)) / n, near / n, len(second) / n, kinds[65:91].sum() / size,
        punctuation / size, kinds[33] / size, kinds[48:58].sum() / size, repeats / size, odd / n, math.log1p(len(words)), sum(map(len, words)) / n,
    ]


_LEXICON, _SECOND = frozenset(LEXICON), frozenset(SECOND)


def dense(text: Column, learned: Column | dict[str, float] | None, both: dict[int, dict[str, float]] | None = None) -> Column:
    """The features as a vector; with ``both``, the word weights are picked by a column of halves."""
    def over(batch: pd.Series, pick_weights) -> pd.Series:
        return pd.Series([features(t or "", pick_weights(i)) for i, t in enumerate(batch)], dtype=object)

    if both is None:
        @F.pandas_udf("array<double>")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield over(batch, lambda i: learned)

        return array_to_vector(scored(text))

    @F.pandas_udf("array<double>")
    def halved(batch: pd.Series, half: pd.Series) -> pd.Series:
        halves = half.tolist()
        return over(batch, lambda i: both[halves[i]])

    return array_to_vector(halved(text, learned))


def word_weights(sample: DataFrame, words: int) -> dict[int, dict[str, float]]:
    """Log-odds of the words and stems that mark toxic texts: learned from half 0, from half 1, and (2) from both; of each at most ``words``."""
    def once(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, half, toxic in zip(batch["text"], batch["half"], batch["toxic"]):
                found = {plain(w) for w in word_list(text or "")}
                out += [(w, half, toxic) for w in found | {" " + w[:STEM] for w in found if len(w) >= STEM} if len(w) > 1]
            yield pd.DataFrame(out, columns=["word", "half", "toxic"]).groupby(["word", "half"])["toxic"].agg(t="sum", n="count").reset_index()

    texts = sample.groupBy("text", "half").agg(F.max("toxic").alias("toxic"))
    counts = texts.mapInPandas(once, "word string, half int, t long, n long").groupBy("word")
    have = lambda c, h: F.sum(F.when(F.col("half") == h, F.col(c)).otherwise(0))
    counts = stored(counts.agg(have("t", 0).alias("t0"), have("n", 0).alias("n0"), have("t", 1).alias("t1"), have("n", 1).alias("n1")).where("t0 + t1 >= 3"))
    size = texts.groupBy("half").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).collect()
    size = {r["half"]: (r["t"], r["n"]) for r in size}
    out = {}
    for which, (t, n, halves) in {0: ("t0", "n0", [0]), 1: ("t1", "n1", [1]), 2: ("t0 + t1", "n0 + n1", [0, 1])}.items():
        total_t, total_n = (sum(size.get(h, (0, 0))[i] for h in halves) for i in (0, 1))
        odds = f"ln(({t} + 0.5) / ({total_t} + 1.0)) - ln(({n} - ({t}) + 0.5) / ({total_n - total_t} + 1.0))"
        best = counts.where(f"{t} >= 3").selectExpr("word", f"{odds} AS odds", f"{t} AS t").where("odds > 1.5")
        out[which] = {r["word"]: r["odds"] for r in best.orderBy(F.desc(F.col("odds") * F.log1p("t")), "word").limit(words).collect()}
    return out


class Model:
    """A fitted scorer."""

    def __init__(self, learned: dict[str, float], trees, calibration, constant: float = 0.0):
        self.learned, self.trees, self.calibration, self.constant = learned, trees, calibration, constant

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, score) of (doc_id, text)."""
        own = pick(docs, "doc_id", "text")
        if self.trees is None:
            return own.select("doc_id", F.lit(self.constant).alias("score"))
        raw = self.trees.transform(own.select("doc_id", dense(F.col("text"), self.learned).alias("features")))
        raw = raw.select("doc_id", vector_to_array("probability")[1].alias("raw"))
        out = self.calibration.transform(raw)
        return out.select("doc_id", F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0)).alias("score"))


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, most: int = MOST, words: int = WORDS) -> Model:
    """Learn from the rows that ``train`` (of doc_id) picks."""
    marked = pick(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out() if train is None else train)
    marked = marked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = most / max(1, marked.count())
    picked = marked.where((F.xxhash64("doc_id") / F.lit(2.0**64)) + F.lit(0.5) <= share)
    own = pick(docs, "doc_id", "text").join(picked, "doc_id")
    sample = stored(own.select("text", "toxic", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half"), (F.pmod(F.xxhash64("text", F.lit(7)), F.lit(4)) == 3).alias("calibrates")))
    toxic, n = sample.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    if not toxic or toxic == n:
        return Model({}, None, None, (toxic or 0) / n if n else 0.0)
    learned = word_weights(sample, words)
    shaped = stored(sample.select(dense(F.col("text"), F.col("half"), {0: learned[1], 1: learned[0]}).alias("features"), F.col("toxic").cast("double").alias("label"), "calibrates"))
    fitting = shaped.where("NOT calibrates")
    if fitting.select("label").distinct().count() < 2 or not shaped.where("calibrates").take(1):
        fitting = shaped
    trees = GBTClassifier(maxIter=25, maxDepth=4, stepSize=0.2, minInstancesPerNode=5, seed=7, cacheNodeIds=False).fit(fitting.coalesce(6))
    rest = shaped.where("calibrates") if shaped.where("calibrates").take(1) else shaped
    raw = trees.transform(rest).select(vector_to_array("probability")[1].alias("raw"), "label")
    return Model(learned[2], trees, IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = fit(docs, table(spark, sf_dir, "labels")).score(docs)
    return out.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
