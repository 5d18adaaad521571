"""Ranked lexical search against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from hangarflow.llm import common, lexical
from tests.llm.rows import SCHEMA, documents

LOWER = str.maketrans(common.UPPER, common.LOWER)


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(rows, items, k):
    docs = [(d, t, Counter(terms(t))) for d, t in rows if terms(t)]
    n, length = len(docs), sum(c.total() for *_, c in docs)
    df = Counter(t for *_, c in docs for t in c)
    out = []
    for item, text in items:
        own = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in set(terms(text)) if df[t]}
        scored = []
        for d, _, tf in docs:
            m = 50 + (50 * tf.total() * n) // length
            s = sum(w * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t, w in own.items() if t in tf)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "w1 W2 w3 word"), (1, "w1 W2 w3 word"), (None, "É é ß"), (2, "nowhere to be found?"), (3, None), (4, ""), (5, "…!?"), (6, "x0 x1 tail5 same line w7 w7 w7 a"), (7, "w" + " w".join(map(str, range(400))))]


@pytest.mark.parametrize("k, cells, step, load, probe", [(50, 1 << 22, 512, 4, 2), (3, 64, 3, 1, 1), (1, 1, 1, 2, 1)])
def test_equals_brute_force(spark, monkeypatch, k, cells, step, load, probe):
    monkeypatch.setattr(lexical, "CELLS", cells)
    monkeypatch.setattr(lexical, "ROWS", step)
    monkeypatch.setattr(lexical, "TERMS", 50)
    docs, rows = documents(spark)
    items = spark.createDataFrame([(t, i, 0, 1) for i, t in ITEMS], "text string, item_id long, term int, w int")
    got = lexical.search(lexical.index(docs.repartition(3), load), items, k, probe)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, ITEMS, k)


def test_string_ids_and_many_copies(spark):
    rows = [(f"d{i % 70:02}", "the same text") for i in range(300)] + [(None, "the same text")] * 5 + [("z", "same same same")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    items = spark.createDataFrame([("q", "Same text")], "item_id string, text string")
    got = lexical.search(lexical.index(docs.repartition(7)), items, 40).collect()
    assert [r["rank"] for r in sorted(got, key=lambda r: r["rank"])] == list(range(1, 41))
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["rank"])]
    assert order == sorted(d for d, _ in rows if d)[:40]  # no term but "the" tells them apart, and it isn't asked


def test_bounds_are_never_below_scores():
    rng = np.random.default_rng(4)
    words = [f"t{i}".encode() for i in range(3000)]
    weights = [[(words[i], int(rng.integers(0, 9000))) for i in rng.choice(3000, 30, False)] for _ in range(20)]
    b = lexical.Block(list(range(20)), weights, 200, 90_000)
    tfs = [Counter(rng.choice(words, rng.integers(1, 2000)).tolist()) + Counter({words[0]: int(rng.integers(1, 10**6))}) for _ in range(60)]
    n = np.array([t.total() for t in tfs])
    seen = 0
    for at, bound in b.bounds(n, [lexical.sketch(t, 2) for t in tfs]):
        for i, j in enumerate(at):
            exact = [b.score(q, tfs[j], b.norm(int(n[j]))) for q in range(20)]
            assert (bound[i] >= exact).all()
            seen += 1
    assert seen == 60
    assert list(lexical.LEVELS[:130]) == [*range(129), 153] and len(lexical.LEVELS) == 256 and (np.diff(lexical.LEVELS) > 0).all()


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(lexical.index(docs), items).collect() == []
    some, _ = documents(spark)
    got = lexical.search(lexical.index(some), items.limit(0))
    assert got.collect() == [] and got.columns == ["item_id", "rank", "doc_id", "score"]
