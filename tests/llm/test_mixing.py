"""Mixing sources to target weights: targets, permutations and texts against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hangarflow.llm import mixing
from tests.llm.rows import SCHEMA, documents


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shared(sizes, weights, share, most):
    """The rule, step by step: full sources stop, their excess goes to the others by weight."""
    w = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, full = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in sizes if s not in full]
        over = [s for s in rest if left * w[s] / sum(w[r] for r in rest) > most * sizes[s]]
        if not over:
            return full | {s: left * w[s] / sum(w[r] for r in rest) for s in rest}
        for s in over:
            full[s] = most * sizes[s]
            left -= full[s]


def corpus(spark):
    rng = random.Random(1)
    _, rows = documents(spark)
    sources = ["hot"] * 6 + ["a", "b", "Z", "é", "", None]
    out = [(d, t, None, rng.choice(sources)) + (None,) * 6 for d, t in rows]
    out += [(500 + i, " ".join(f"{s}{i}_{j}" for j in range(rng.randrange(60))), None, s) + (None,) * 6 for i in range(80) for s in [rng.choice(sources)]]
    out += [(7, "copy of one row", None, "hot") + (None,) * 6] * 9 + [(901, "tiny", None, "small") + (None,) * 6, (902, " ", None, "wordless") + (None,) * 6]
    return spark.createDataFrame(out, SCHEMA), out


@pytest.mark.parametrize("length, shards, weights, share, most", [(512, 1024, (3, 1, 2), 1.5, 2), (7, 16, (3, 1, 2), 1.5, 2), (16, 3, (1, 9), 1.0, 3), (5, 64, (1,), 0.3, 1), (9, 4, (5, 1), 4.0, 2)])
def test_targets_are_met(spark, length, shards, weights, share, most):
    docs, rows = corpus(spark)
    m = mixing.mix(docs, weights, share, most, length, shards, buckets=8)
    got = mixing.taken(m).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(split(r[1]))
    want = shared(sizes, weights, share, most) if share < most else {s: most * n for s, n in sizes.items()}
    assert Counter((r["source"], r["doc_id"], r["size"]) for r in got) == Counter((r[3], r[0], len(split(r[1]))) for r in rows)
    assert {r["source"]: r["source_size"] for r in got} == dict(sizes)
    for source, target in want.items():
        own = [r for r in got if r["source"] == source]
        assert own[0]["target"] == pytest.approx(target) and sum(r["taken"] for r in own) == pytest.approx(target, abs=0.51)
    assert all(r["taken"] <= most * r["size"] for r in got)
    if most * sizes["hot"] > 400 and want["hot"] < most * sizes["hot"] - 400 and length < 100:
        assert len({r["taken"] / r["size"] for r in got if r["source"] == "hot" and r["size"] > 3}) > 1


def test_same_whatever_the_partitioning(spark):
    docs, _ = corpus(spark)
    one, two = (mixing.mix(d, length=7, shards=9, buckets=5) for d in (docs, docs.orderBy(F.desc("text")).repartition(5)))
    rows = lambda m: sorted(map(tuple, mixing.taken(m).collect()), key=repr)
    assert rows(one) == rows(two)
    slots = lambda m: sorted(map(tuple, m.slots.collect()))
    assert slots(one) == slots(two)
    other = mixing.mix(docs, length=7, shards=9, buckets=5, seed=1)
    assert slots(other) != slots(one) and rows(other) != rows(one)


def test_texts(spark):
    """The mix's own texts: blocks of whole runs of words, each word as often as ``taken`` says."""
    docs, rows = corpus(spark)
    m = mixing.mix(docs, length=7, shards=9, buckets=5)
    out = mixing.texts(m, docs).collect()
    assert len(out) == m.slots.count() and all(len(r["text"].split(" ")) <= 7 for r in out)
    assert max(r["shard"] for r in out) == 8
    got = defaultdict(Counter)
    for r in out:
        got[r["source"]].update(r["text"].split(" "))
    total, own = Counter(), defaultdict(Counter)
    for r in mixing.taken(m).collect():
        total[r["source"]] += r["taken"]
    for r in rows:
        own[r[3]].update(split(r[1]))
    for source, words in got.items():
        assert words.total() == total[source]
        assert all(n <= 2 * own[source][w] for w, n in words.items())
    whole = {tuple(split(r[1])) for r in rows}
    assert any(tuple(t["text"].split(" "))[1:5] in {w[i:i + 4] for w in whole for i in range(len(w))} for t in out)


def test_permutations(spark):
    for n in (1, 2, 3, 10, 97, 512):
        df = spark.range(n).select("id", *(mixing.permuted(F.col("id"), F.lit(n), F.lit(3), F.lit(k)).alias(f"p{k}") for k in range(3)))
        df = df.withColumn("back", mixing.permuted(F.col("p0"), F.lit(n), F.lit(3), F.lit(0), back=True))
        rows = df.collect()
        for k in range(3):
            assert sorted(r[f"p{k}"] for r in rows) == list(range(n))
        assert all(r["back"] == r["id"] for r in rows)
        if n > 90:
            assert len({tuple(r[f"p{k}"] for r in rows) for k in range(3)}) == 3
            assert sum(abs(r["p0"] - r["id"]) for r in rows) / n > n / 5


def test_shards_are_multinomial(spark):
    """A shard's share of a source spreads as independent draws do: neither equal in all shards nor in runs."""
    plan = spark.createDataFrame([(0, "a", 1, 1.0, 6000, 1, 6000, None), (1, "b", 1, 1.0, 3000, 1, 3000, None), (2, "c", 1, 1.0, 1000, 1, 1000, None)],
                                 "src int, source string, size long, target double, blocks long, short long, slots long, cut long")
    s = mixing.drawn(plan, 1, 100, 0)
    assert {r["src"]: r["count"] for r in s.groupBy("src").count().collect()} == {0: 6000, 1: 3000, 2: 1000}
    assert s.select("src", "block").distinct().count() == 10_000
    per = [r["n"] for r in s.groupBy("shard").agg(F.count(F.when(F.col("src") == 1, 1)).alias("n")).where("shard < 95").collect()]
    mean = sum(per) / len(per)
    var = sum((x - mean) ** 2 for x in per) / (len(per) - 1)
    assert abs(mean - 30) < 3 and 10 < var < 40  # 100 x 0.3 x 0.7 = 21


def test_empty(spark):
    assert mixing.taken(mixing.mix(spark.createDataFrame([], SCHEMA))).collect() == []
    nothing = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id int, text string, source string")
    m = mixing.mix(nothing)
    assert sorted((r["doc_id"], r["size"], r["target"], r["taken"]) for r in mixing.taken(m).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    assert mixing.texts(m, nothing).collect() == []
