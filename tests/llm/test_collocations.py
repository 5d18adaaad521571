"""Phrase collocations against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hangarflow.llm import collocations, common
from tests.llm.rows import SCHEMA, documents

LOWER = str.maketrans(common.UPPER, common.LOWER)


def brute(rows, longest, least, percent, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, min(longest, len(w) - i) + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, all_f in f.items():
        some = {p: c for p, c in all_f.items() if c >= least and len(p) > 1}
        inner = defaultdict(int)
        for p, c in some.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inner[p[i:i + k]] = max(inner[p[i:i + k]], c)
        found = []
        for p, a in some.items():
            if 100 * inner[p] >= percent * a:
                continue
            score, k = min((1000 * a * n[lang] // (all_f[p[:k]] * all_f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), all_f[p[:k]], all_f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(spark):
    rng = random.Random(3)
    docs, _ = documents(spark)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    base = [" ".join(rng.choice("a b c d A, e. f\tg é Éa x! \x0b \x0c \r y \x1f \xa0 z".split(" ")) for _ in range(80)) for _ in range(30)]
    rows += [(rng.choice(["en", "de", None, "und"]), t) for t in base + base[:9]] + [("fr", "only one here"), ("xx", "the very same pair " * 300)]
    return spark.createDataFrame([(i, t, lang) + (None,) * 7 for i, (lang, t) in enumerate(rows)], SCHEMA), rows


@pytest.mark.parametrize("budget, chunk, known, ranks, longest, least, percent, top", [
    (1 << 20, 1 << 21, 1 << 19, 1 << 20, 5, 5, 100, 50), (40, 700, 9, 1 << 20, 5, 4, 100, 2000), (15, 100, 60, 5, 3, 3, 60, 10), (500, 3000, 10, 0, 2, 10, 100, 7),
    (3, 400, 1, 1, 5, 20, 90, 300)])
def test_equals_brute_force(spark, monkeypatch, budget, chunk, known, ranks, longest, least, percent, top):
    """With small limits: prefixes grow, words are forgotten and met again, and most are sent by their codes."""
    for name, value in (("CHUNK", chunk), ("KNOWN", known), ("RANKS", ranks)):
        monkeypatch.setattr(collocations, name, value)
    docs, rows = corpus(spark)
    got = collocations.collocations(docs.repartition(3), longest, least, percent, top, budget)
    assert sorted(map(tuple, got.collect())) == brute(rows, longest, least, percent, top)
    assert dict(got.dtypes)["rank"] == "bigint" and got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_prefixes_over_budget_grow_until_they_fit(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 500)
    docs, rows = corpus(spark)
    words, chunks = collocations.vocabulary(docs)
    frequent = spark.sparkContext.broadcast(collocations.marks(words.where("f >= 3")))
    hot = collocations.over_budget(chunks, words, frequent, 50, 5)
    counts = defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            for k in (1, 2, 3, 4):
                for i in range(len(w) - k + 1):
                    counts[k][(lang, *w[i:i + k])] += 1
    assert [len(h) for h in hot][0] == sum(c > 50 for c in counts[1].values())
    assert len(hot[1]) >= sum(c > 50 for p, c in counts[2].items()) > 0


def test_codes_shared_by_two_words_are_noticed(spark, monkeypatch):
    """With codes of 3 bits some words collide under every seed tried; none may be taken."""
    import xxhash

    docs = spark.createDataFrame([("en", "a b c d")], "lang string, text string")
    real, seeds = collocations.encoded, []

    def poor(docs, seed):
        seeds.append(seed)
        out = real(docs, seed)
        return out if seed else out.withColumn("code", F.when(F.col("code").isNotNull(), F.lit(7).cast("long")))

    monkeypatch.setattr(collocations, "encoded", poor)
    words, _ = collocations.vocabulary(docs)
    assert seeds == [0, 1] and words.count() == 4
    assert {r["code"] for r in words.collect()} == {int(np.uint64(xxhash.xxh3_64_intdigest(b"en\n" + w, 1) | 1).astype(np.int64)) for w in (b"a", b"b", b"c", b"d")}


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    found = spark.createDataFrame([([1, 3], 9_000_000)], "w array<long>, f long")
    counts = spark.createDataFrame([([1, 3], 9_000_000), ([1], 9_000_001), ([3], 10_000_007)], "w array<long>, f long")
    words = spark.createDataFrame([("en", b"p", 1, 9_000_001), ("en", b"q", 3, 10_000_007)], "lang string, word binary, code long, f long")
    totals = spark.createDataFrame([("en", big)], "lang string, n long")
    got = collocations.scored(found, counts, totals, words).first()
    assert got["score"] == 1000 * 9_000_000 * big // (9_000_001 * 10_000_007)


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(docs).collect() == []
    some = spark.createDataFrame([(1, None, None), (2, "", "en"), (3, " .,\n", "en"), (4, "one", "en")], "id int, text string, lang string")
    assert collocations.collocations(some, least=1).collect() == []
