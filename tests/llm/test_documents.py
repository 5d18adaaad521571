"""Operators on documents against brute force on a small table of awkward cases."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hangarflow.llm import bpe, common, decontam, langid, licenses, linededup, longrepeats, minhash, toxicity
from tests.compare import compare
from tests.llm.rows import SCHEMA, documents

LOWER = str.maketrans(common.UPPER, common.LOWER)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_line_dedup(spark):
    docs, rows = documents(spark)
    key = lambda line: line.strip(common.SPACES).translate(LOWER)
    found = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            found[key(line)].add((d, t))
    often = {k for k, v in found.items() if k and len(v) >= 10}
    assert often
    want = Counter()
    for d, t in rows:
        kept = [x for x in (t or "").split("\n") if key(x) not in often]
        want[d, len((t or "").split("\n")), len((t or "").split("\n")) - len(kept), "\n".join(kept)] += 1
    for batches, fan in ((4, 4), (1, 4), (5, 2)):
        out = linededup.drop_frequent_lines(docs, batches=batches, fan=fan)
        got = Counter(tuple(r) for r in out.select("_0", F.size("_lines"), F.coalesce(F.size("_dropped"), F.lit(0)), "_kept").collect())
        assert got == want
    clean = linededup.cleaned(docs)
    assert clean.schema.names == docs.schema.names and clean.count() == len(rows)
    assert {r["n_chars"] for r in clean.where("doc_id = 0").collect()} == {len(next(k[3] for k in want if k[0] == 0))}


def test_repeated_rows_are_one_document(spark, tmp_path):
    """Ten copies of a row drop nothing, one text under ten ids does, a null id is an id; the SQL agrees."""
    rows = [(1, "copied row")] * 10 + [(i, "ten ids\nown " + str(i)) for i in range(10, 19)] + [(None, "ten ids"), (None, "ten ids")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = Counter(tuple(r) for r in linededup.drop_frequent_lines(docs).select("_0", "_kept").collect())
    assert kept == Counter([(1, "copied row")] * 10 + [(i, f"own {i}") for i in range(10, 19)] + [(None, "")] * 2)
    assert compare(linededup.op10_line_dedup(spark, str(tmp_path)), duckdb_of(tmp_path), common.SQL["op10_line_dedup"]) is None


def test_line_runs_are_compacted_and_skip_settled_lines(spark):
    runs = linededup.LineRuns(spark, min_docs=2, fan=2)
    batch = lambda *h: spark.createDataFrame([(bytes([x]),) for x in h], "h binary")
    runs.add(batch(1, 1, 2))
    runs.add(batch(1, 2, 3))
    assert [len(x) for x in runs.levels] == [0, 1]
    assert {r["h"][0] for r in runs.settled().collect()} == {1, 2}
    runs.add(batch(1, 3, 3, 4))
    assert {(r["h"][0], r["n"]) for r in spark.read.parquet(runs.levels[0][0]).collect()} == {(3, 2), (4, 1)}
    assert {r["h"][0] for r in runs.settled().collect()} == {1, 2, 3}


def hit_words(w, phrases):
    hit, items = set(), set()
    for item, p in phrases:
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                hit |= set(range(i, i + len(p)))
                items.add(item)
    return hit, items


def test_decontamination(spark):
    docs, rows = documents(spark)
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    items = [(1, " ".join((rows[0][1] or "").split()[3:30]).upper()), (2, "É,é"), (10, "!!"), (3, None), (4, "word word word"), (5, "w1"), (6, "Word! " * 12), (6, "Word! " * 12), (7, "nowhere ever"),
             (None, " ".join(split(rows[4][1])[-12:]))]
    bench = spark.createDataFrame([(i, t, "q", 1) for i, t in items], "item_id long, text string, term string, n int")
    phrases = []
    for i, t in items:
        w = split(t)
        n = min(10, len(w))
        phrases += [("" if i is None else str(i), w[s:s + n]) for s in range(len(w) - n + 1)] if w else []
    want = {}
    for d, t in rows:
        if d is not None:
            hit, found = hit_words(split(t), phrases)
            want[d] = (len(split(t)), len(hit), len(found), ",".join(sorted(found)))
    got = {r["doc_id"]: tuple(r)[1:] for r in decontam.contamination(docs, bench).collect()}
    assert got.pop(None)[0] == 5
    assert got == want
    for d, b in ((docs.limit(0), bench), (docs, bench.limit(0))):
        assert decontam.contamination(d, b).where("n_hit > 0").count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta x gamma"), (2, "gamma beta alpha"), (3, "alpha beta " + "x " * 40 + "gamma"), (4, None)], "doc_id long, text string")
    _, terms = decontam.phrases(spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string"))
    index = decontam.postings(docs, terms)
    assert {r["doc_id"] for r in decontam.near(index, terms, 6).collect()} == {1, 2}
    assert {r["doc_id"] for r in decontam.near(index, terms, 5).collect()} == {2}
    assert {r["doc_id"] for r in decontam.near(index, terms, 60).collect()} == {1, 2, 3}
    assert decontam.exact(index, terms).count() == 0


def jaccard_groups(rows, percent):
    sets = [minhash.shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common_ = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common_ >= percent * (len(sets[i]) + len(sets[j]) - common_):
                group[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sets, [least.get(top(i)) if sets[i] else rows[i][0] for i in range(len(rows))]


def test_minhash(spark):
    docs, rows = documents(spark)
    sets, component = jaccard_groups(rows, 80)
    want = Counter((d, len(s), c, d == c) for (d, _), s, c in zip(rows, sets, component))
    got = Counter(tuple(r) for r in minhash.near_duplicates(docs).drop("v").collect())
    assert got == want
    assert len(set(component)) < len(rows) - 8
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_minhash_links_across_labels(spark):
    """Chains of near copies, where neighbours are linked and ends aren't: no link may be lost."""
    base = [f"t{i}" for i in range(100)]
    rows = []
    for i in range(30):
        w = list(base)
        for j in range(i):
            w[3 * j] = f"n{j}"
        rows.append((100 - i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, component = jaccard_groups(rows, 80)
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs).collect()} == dict(zip((d for d, _ in rows), component))


def test_minhash_splits_long_lists(spark):
    """Documents that share a frequent line, with near copies among them: split lists find the same groups."""
    import random

    rng = random.Random(3)
    line = [f"l{i}" for i in range(14)]
    rows = []
    for i in range(60):
        w = line + [f"o{i}_{j}" for j in range(10)]
        rows.append((i, " ".join(w)))
        if i % 4 == 0:
            w[rng.randrange(len(w))] = "changed"
            rows.append((500 - i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, component = jaccard_groups(rows, 80)
    nodes = minhash.classes(minhash.signatures(docs))
    for long, few in ((5, 2), (10**6, 0)):
        edges = minhash.components(minhash.links(docs, nodes, long=long, few=few))
        ids = {r["node"]: r["id"] for r in nodes.collect()}
        got = {}
        for r in edges.collect():
            got.setdefault(r["component"], set()).add(ids[r["node"]])
        want = {}
        for (d, _), c in zip(rows, component):
            want.setdefault(c, set()).add(d)
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def near_and_unlike(rng):
    """Near copies of one text, of which those with most changes link with few or none, and texts that share some words by chance."""
    base = [f"b{i}" for i in range(148)]
    rows = []
    for i in range(300):
        w = list(base)
        for j in rng.sample(range(148), i % 12):
            w[j] = f"x{i}_{j}"
        rows.append((i, " ".join(w)))
    return rows, [(1000 + i, " ".join(f"v{rng.randrange(14)}" for _ in range(60))) for i in range(300)]


@pytest.mark.parametrize("part, most", ((0, 50), (1, 80)))
def test_minhash_compares_no_large_group_pair_by_pair(spark, monkeypatch, part, most):
    import random

    rows = near_and_unlike(random.Random(8))[part]
    sets = [minhash.shingles(t, 2) for _, t in rows]
    group = list(range(len(rows)))
    for i, s in enumerate(sets):
        for j in range(i):
            common_ = len(s & sets[j])
            if 100 * common_ >= 80 * (len(s) + len(sets[j]) - common_) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    want = {d: min(e for (e, _), h in zip(rows, group) if h == g) for (d, _), g in zip(rows, group)}
    compared, agreeing = [], minhash.agreeing
    monkeypatch.setattr(minhash, "agreeing", lambda pairs, *rest: compared.append(pairs.count()) or agreeing(pairs, *rest))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, width=2).collect()} == want
    assert sum(compared) < most * len(rows), compared
    if not part:
        assert 1 < len(set(want.values())) < len(rows) // 2


def test_components(spark):
    edges = [(i + 1, i) for i in range(20)] + [(40, 35), (40, 36), (41, 36), (50, 50)] + [(100 + i, 200) for i in range(30)]
    got = {r["node"]: r["component"] for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(21)) and {got[i] for i in (35, 36, 40, 41)} == {35} and got[200] == 100 and got[129] == 100
    assert minhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(rows, length, keep_first=False):
    data = [(t or "").encode() for _, t in rows]
    seen = defaultdict(list)
    for r, b in enumerate(data):
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]].append((r, i))
    out = []
    for r, b in enumerate(data):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            places = seen[b[i:i + length]]
            if len(places) > 1 and not (keep_first and places[0] == (r, i)):
                gone[i:i + length] = b"\1" * length
        runs = re.findall(rb"\x01+", bytes(gone))
        out.append((len(b), sum(gone), len(runs), sha(bytes(c for c, g in zip(b, gone) if not g))))
    return out


@pytest.mark.parametrize("length,gram,in_task", [(60, 30, 4096), (60, 30, 1), (400, 200, 4096), (47, 46, 4096)])
def test_long_repeats(spark, length, gram, in_task):
    docs, rows = documents(spark)
    want = Counter(zip((d for d, _ in rows), brute_repeats(rows, length)))
    out = longrepeats.without_repeats(docs, length=length, gram=gram, in_task=in_task)
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    got = Counter((r[0], tuple(r)[1:]) for r in out.select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256)).collect())
    assert got == want
    assert sum(r[1] for _, r in want.elements()) > 0


@pytest.mark.parametrize("in_task", [4096, 1])
def test_long_repeats_keep_first(spark, in_task):
    _, rows = documents(spark)
    rows = [r for i, r in enumerate(rows) if r[0] is not None and r not in rows[:i]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = dict(zip((d for d, _ in rows), brute_repeats(rows, 60, True)))
    out = longrepeats.without_repeats(docs, length=60, gram=30, keep_first=True, in_task=in_task)
    got = {r["doc_id"]: (r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), sha(bytes(r["kept"]))) for r in out.collect()}
    assert got == want
    assert longrepeats.without_repeats(docs.limit(0)).count() == 0


def test_licenses(spark):
    docs, rows = documents(spark)
    extra = [(901, "Intro.\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the "
              "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
              "persons to whom the Software is furnished to do so, subject to the following conditions:\nOne more.\nThe above copyright notice and this permission notice shall be included in all "
              "copies or substantial portions of the Software."), (902, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
              "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."), (903, "x. ALL RIGHTS  RESERVED! Released under the MIT License."),
             (904, "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the software.")]
    more = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    got = {r["doc_id"]: sorted((f["license"], f["first"], f["sentences"]) for f in r["found"]) for r in licenses.scan(more).collect()}
    assert got[901] == [("MIT", 1, 3)] and got[903] == [("MIT", 2, 1), ("proprietary", 1, 1)] and got[904] == []
    assert got[902] == [("GPL-3.0", 0, 2)]
    assert all(not v for k, v in got.items() if k is None or k < 900) and licenses.scan(more).count() == len(rows) + 4
    assert licenses.scan(docs.limit(0)).count() == 0


def test_wrapped_licenses(spark, tmp_path):
    """Verbatim texts in their usual layout: wrapped, in comment blocks, as lists."""
    mit = """MIT License

Copyright (c) 2024 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
    gpl = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1} either version {2} of the License, or
(at your option) any later version."""
    bsd = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
    isc = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
    mpl = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
    apache = """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/"""
    block = lambda t, mark: "\n".join(f"{mark} {x}".rstrip() for x in t.split("\n"))
    texts = [(mit, {"MIT"}), (mit.split("\n\n", 2)[2], {"MIT"}), ("The MIT License (MIT)\n\nother", {"MIT"}), (gpl.format(":", ",", 3), {"GPL-3.0"}), (gpl.format(";", ";", 2), {"GPL-2.0"}),
             (bsd, {"BSD-2-Clause", "BSD-3-Clause"}), (bsd.split("\n\n3.")[0], {"BSD-2-Clause"}), (isc, {"ISC"}), (mpl, {"MPL-2.0"}), (apache, {"Apache-2.0"})]
    rows = [(f(t), want) for t, want in texts for f in (str, lambda t: t.replace("\n", "\r\n"), lambda t: block(t, "#"), lambda t: block(t, "//"), lambda t: "/*\n" + block(t, " *") + "\n */")]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: {f["license"] for f in r["found"]} for r in licenses.scan(docs).collect()}
    assert [got[i] for i in range(len(rows))] == [want for _, want in rows]
    # The registered query is the same scan.
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: r["licenses"] for r in licenses.op6_license_scan(spark, str(tmp_path)).collect()}
    assert [out[i] for i in range(len(rows))] == [",".join(sorted(want)) for _, want in rows]
    assert compare(licenses.op6_license_scan(spark, str(tmp_path)), duckdb_of(tmp_path), licenses._oracle()) is None


def duckdb_of(folder):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    return con


def test_licenses_equal_their_sql_on_awkward_texts(spark, tmp_path):
    docs, _ = documents(spark)
    more = ["# SPDX-License-Identifier: Apache-2.0", "// SPDX-License-Identifier: GPL-2.0-or-later\nint x;", "All rights\nreserved.", "* All rights\n * reserved.", "dnl all rights\nrem reserved",
            "\u2028all rights reserved\x85", "all rights reserved\x85", "all rights\n \t\n reserved", "All rights\r\n// reserved\r", "é all rights reserved", "License v. 2. All rights reserved", "<!-- all rights reserved -->", "#all rights reserved*/"]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(700 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert compare(licenses.op6_license_scan(spark, str(tmp_path)), duckdb_of(tmp_path), licenses._oracle()) is None
    got = {r["doc_id"]: r["licenses"] for r in licenses.op6_license_scan(spark, str(tmp_path)).collect()}
    assert got[700] == "Apache-2.0" and got[701] == "GPL-2.0-or-later" and [got[i] for i in (702, 703, 704)] == ["proprietary"] * 3 and got[707] == ""


def test_every_place_of_a_rule(spark):
    text = "Intro.\nReleased under the MIT License.\nx.\ny.\nReleased under the MIT License.\nAll rights reserved.\nreleased under the mit license"
    found = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["found"]
    assert sorted((f["license"], f["first"], f["sentences"]) for f in found) == [("MIT", 1, 1), ("MIT", 4, 1), ("MIT", 6, 1), ("proprietary", 5, 1)]


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(common.tokenizer_file())
    docs, rows = documents(spark)
    more = ["Σίσυφος ΣΑΣ ÅÅ ﬁ² Ⅳ 漢字かな가 😀 it's we'LL   x", "<|startoftext|>a<|endoftext|><|ENDOFTEXT|>", "\x00\x85'", "İstanbul don''t 12345"]
    docs = docs.unionByName(spark.createDataFrame([(800 + i, t) for i, t in enumerate(more)], "doc_id long, text string"), allowMissingColumns=True)
    want = Counter()
    for d, t in rows + [(800 + i, t) for i, t in enumerate(more)]:
        ids = own.encode(t or "", add_special_tokens=False).ids
        want[d, len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(own.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(tuple(r) for r in bpe.digests(bpe.encoded(docs)).collect()) == want
    apart = docs.select("doc_id", bpe.encode(spark)("text").alias("ids")).select("doc_id", "ids", bpe.decode(spark)("ids").alias("decoded"))
    assert Counter(tuple(r) for r in bpe.digests(apart).collect()) == want


def test_stale_heap_entries():
    rules = {(1, 2): (1, 12), (2, 3): (0, 23), (1, 23): (5, 123), (12, 3): (2, 9)}
    assert bpe.merge_word([1, 2, 3], rules) == [123]
    assert bpe.merge_word([1, 1, 1], {(1, 1): (0, 11)}) == [11, 1]
    assert bpe.merge_word([7], rules) == [7]


def test_language(spark):
    docs, rows = documents(spark)
    out = langid.identify(docs, train=F.lit(True))
    assert out.columns == docs.columns + ["_language"] and out.count() == len(rows)
    got = {r["doc_id"]: r["_language"] for r in out.collect()}
    for d, t in rows:
        if d is not None:
            assert (got[d]["lang_pred"] == "und") == (not any(c.isalpha() for c in t or "")), t
            assert 0 <= got[d]["score"] <= 1
    blank = langid.identify(docs, train=F.lit(False)).select("_language.*").distinct().collect()
    assert [tuple(r) for r in blank] == [("und", 0.0)]
    assert langid.identify(docs.limit(0)).count() == 0


def test_ngrams_of_words():
    table = langid.letters()
    assert len(langid.ngrams("Ab", table)) == 2 + 3 + 2 and len(langid.ngrams("a", table)) == 1 + 2 + 1
    assert sorted(langid.ngrams("AB, cd", table)) == sorted([*langid.ngrams("ab", table), *langid.ngrams("..cd", table)])
    assert not len(langid.ngrams(" 12", table))


def test_held_out_accuracy(spark):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    out = langid.identify(docs).where(langid.held_out()).select(F.avg((F.col("lang") == F.col("_language.lang_pred")).cast("int"))).first()[0]
    assert out >= 0.97
    from hangarflow.llm.queries import QUERIES

    scored = QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.01").join(common.table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").where("held_out").toPandas()
    rank, ones = scored["score"].rank(), scored["toxic"] == 1
    auc = (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())
    assert auc >= 0.8 and scored["score"].between(0, 1).all()


def test_toxicity_cases(spark):
    docs, rows = documents(spark)
    labels = spark.createDataFrame([(d, d % 2, "x") for d, _ in rows if d is not None] + [(None, 1, "x"), (3, None, "x"), (3, 1, "x")], "doc_id long, toxic int, text string")
    out = toxicity.fit(docs, labels).score(docs)
    assert out.count() == len(rows) and out.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert {r["score"] for r in toxicity.fit(docs, labels.limit(0)).score(docs).collect()} == {0.0}
    assert toxicity.features("You id1ot, M0R0N!! shut up", {"idiot": 2.0})[:3] == [0.6, 0.4, 2.0]
    assert len(toxicity.features("", {})) == len(toxicity.FEATURES)
    assert spark.createDataFrame([], SCHEMA).count() == 0
