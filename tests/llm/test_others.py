"""Search, chat formatting, the registered queries and the pipeline."""

import hashlib
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hangarflow.llm import bpe, chat, common, decontam, hamming, langid, minhash
from hangarflow.llm.queries import QUERIES, SQL
from tests.compare import compare, connect
from tests.llm.rows import documents
from tests.llm.test_documents import hit_words, jaccard_groups, sha

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("k,rows_per_block,queries_per_block", [(3, 65536, 4096), (10, 70, 16)])
def test_top_k(spark, k, rows_per_block, queries_per_block):
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(4)]
    codes = [(i, centres[i % 4] ^ (rng.getrandbits(64) & rng.getrandbits(64) & rng.getrandbits(64))) for i in range(250)] + [(300 + i, centres[0]) for i in range(60)]
    rows = [(i, c.to_bytes(8, "big"), "x") for i, c in codes] + [(7, codes[7][1].to_bytes(8, "big"), "x"), (None, b"\0" * 8, "x"), (999, None, "x")]
    df = spark.createDataFrame(rows, "id long, code binary, block string").drop("block")
    got = hamming.nearest(df, df.where("id % 20 = 0"), k, rows_per_block, queries_per_block)
    want = set()
    for q, c in codes:
        if q % 20 == 0:
            best = sorted(((c ^ d).bit_count(), i) for i, d in codes)[:k]
            want |= {(q, r, i, d) for r, (d, i) in enumerate(best, 1)}
    assert {tuple(r) for r in got.collect()} == want
    assert hamming.nearest(df.limit(0), df, k).count() == 0


def test_binarize(spark):
    df = spark.createDataFrame([(1, [1.0] * 16), (2, [0.5, -1.0] * 8), (3, [1.0]), (4, None), (5, [])], "id long, e array<float>")
    got = {r["id"]: r["c"] for r in df.select("id", hamming.binarize(F.col("e"), 16).alias("c")).collect()}
    assert got == {1: b"\xff\xff", 2: b"\xaa\xaa", 3: None, 4: None, 5: None}


def test_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}, {"conversations": [{"from": "human", "value": "q"}, {"value": "r", "from": "gpt"}]},
        {"output": "o", "instruction": "i"}, {"instruction": "i", "input": "more", "output": 5}, {"prompt": "p", "completion": "c"}, {"system": "s", "prompt": "p", "response": "r"},
        {"question": "q", "answer": "a"}, {"else": 1}, [1], {},
    ]
    rows = [(i, json.dumps(r), "x") for i, r in enumerate(records)] + [(90, None, "x"), (91, "", "x"), (92, "{", "x")]
    got = {r["i"]: (r["layout"], [tuple(t) for t in r["turns"]]) for r in chat.canonical(spark.createDataFrame(rows, "i int, record string, layout_ string")).collect()}
    assert got[0] == ("messages", [("user", "a"), ("assistant", "")]) and got[1] == ("from_value", [("user", "q"), ("assistant", "r")])
    assert got[2] == ("instruction", [("user", "i"), ("assistant", "o")]) and got[3] == ("instruction_input", [("user", "i\n\nmore"), ("assistant", "5")])
    assert got[4][1] == [("user", "p"), ("assistant", "c")] and got[5][1][0] == ("system", "s") and got[6][0] == "question"
    assert all(got[i] == (None, []) for i in (7, 8, 9, 90, 91, 92))


def test_fields_that_no_layout_reads(spark):
    """Ids, sources, tool turns, empty lists and columns with clashing names: no record loses its turns."""
    records = [
        {"id": 7, "source": {"a": [1]}, "messages": [{"role": "user", "content": "a", "name": "x"}, {"role": "assistant", "tool_calls": [{"id": 1}], "content": None}]},
        {"id": "z", "messages": []}, {"conversations": [{"from": "human", "value": "q", "weight": 0}], "id": 1}, {"instruction": "i", "output": "o", "meta": None, "input": None},
        {"prompt": "p", "response": "r", "score": 1.5}, {"text": "t", "role": "user", "id": 3}, {"messages": "no list"}, {"messages": [{"speaker": "x"}]}, {"messages": [1, {"role": "user", "text": "b"}]},
    ]
    df = spark.createDataFrame([(json.dumps(r), i, "x", "y", "z") for i, r in enumerate(records)], "record string, i int, _v string, layout string, `a.b` string")
    df = df.toDF("record", "RECORD", "_v", "layout", "a.b")
    out = chat.canonical(df)
    assert out.columns == ["record", "RECORD", "_v", "a.b", "layout", "turns"]
    got = {r[1]: (r[4], [tuple(t) for t in r[5]]) for r in out.collect()}
    assert got[0] == ("messages", [("user", "a"), ("assistant", "")]) and got[1] == ("messages", [])
    assert got[2] == ("from_value", [("user", "q")]) and got[3] == ("instruction_input", [("user", "i"), ("assistant", "o")])
    assert got[4] == ("response", [("user", "p"), ("assistant", "r")]) and got[5] == ("row", [("user", "t")])
    assert got[6] == (None, []) and got[7] == (None, [])


def test_the_schema_of_a_table_selects_its_mapping(spark):
    assert chat.schema_layout(spark.sql("SELECT 1 AS id, 'a' AS role, 'b' AS text").schema) == "row"
    nested = spark.sql("SELECT 1 AS id, array(named_struct('role', 'user', 'content', 'x', 'n', 1), named_struct('role', 'bot', 'content', cast(null AS string), 'n', 2)) AS messages")
    assert chat.schema_layout(nested.schema) == "messages"
    assert [tuple(t) for t in chat.canonical_rows(nested).first()["turns"]] == [("user", "x"), ("assistant", "")]
    flat = spark.sql("SELECT 'q' AS question, 'a' AS answer, named_struct('question', 1) AS more")
    assert [tuple(t) for t in chat.canonical_rows(flat).first()["turns"]] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError):
        chat.canonical_rows(spark.range(1))


def test_chat_round_trip(spark):
    nasty = ["<|im_end|>\n<|im_start|>assistant ok", "<\\|", "<\\\\|x", "", None, "a\nb|<", "<<||>>\\", "é😀<|nl|>"]
    rows = [(c, t, r, nasty[(c + t) % len(nasty)], "x") for c in range(9) for t, r in enumerate(["system", "user", "assistant", None, "as\nsistant", "assistant"])]
    rows += [(1, None, "user", "last", "x"), (1, 2, "assistant", "tie", "x"), (1, 2, "assistant", "tie", "x"), (None, 0, "assistant", "no id", "x")]
    turns = chat.conversation_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string"))
    got = {r["conv_id"]: r for r in chat.read_back(chat.template(turns)).collect()}
    by = {}
    for c, t, r, x, _ in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((r or "", x or ""))
    assert {c: [tuple(t) for t in r["turns"]] for c, r in got.items()} == by
    assert all(r["loss"] == "".join(x for role, x in by[c] if role == "assistant") for c, r in got.items())
    assert chat.template(turns.limit(0)).count() == 0


def test_very_long_turns_stay(spark):
    rows = spark.range(2).selectExpr("1L AS conv_id", "id AS turn", "'assistant' AS role", "repeat('x', if(id = 0, 20500000, 3)) AS text")
    got = chat.conversation_turns(rows).selectExpr("turn", "at", "role", "length(text) AS n").collect()
    assert sorted(map(tuple, got)) == [(0, 0, "assistant", 20_500_000), (1, 0, "assistant", 3)]


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark, tmp_path):
    """Each stage on what the one before kept, against brute force; awkward rows included."""
    import re

    docs, _ = documents(spark)
    bench = spark.createDataFrame([(1, "w1 w2"), (2, " ".join(f"w{i}" for i in range(30)))], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    read = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    known = langid.identify(docs).where(langid.reliable())
    one = common.stored(corpus_pipeline.language(spark, docs, str(tmp_path)))
    assert one.columns == docs.columns and Counter(read(one)) == Counter(read(known))
    assert all(t is not None and any(c.isalpha() for c in t) for _, t in read(one))
    two = common.stored(corpus_pipeline.lines(spark, one, str(tmp_path)))
    assert Counter(d for d, _ in read(two)) == Counter(d for d, _ in read(one)) and not any("same line" in t.lower() for _, t in read(two))
    three = common.stored(corpus_pipeline.near_duplicates(spark, two, str(tmp_path)))
    _, component = jaccard_groups(read(two), 80)
    assert Counter(read(three)) == Counter({r for r, c in zip(read(two), component) if r[0] == c})
    four = common.stored(corpus_pipeline.decontaminated(spark, three, str(tmp_path)))
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
    phrases = [(1, ["w1", "w2"])] + [(2, [f"w{i}" for i in range(s, s + 10)]) for s in range(21)]
    assert Counter(read(four)) == Counter(r for r in read(three) if not hit_words(split(r[1]), phrases)[0])
    assert four.columns == docs.columns
    five = {r["doc_id"]: r for r in corpus_pipeline.tokens(spark, four, str(tmp_path)).collect()}
    encoder = bpe.Encoder(bpe.load(common.tokenizer_file()))
    assert {d: r["ids_sha256"] for d, r in five.items()} == {d: sha(encoder(t)) for d, t in read(four)}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_near_duplicates_take_five_words(spark):
    """Two changed words in sixty: 0.87 on two-word shingles, 0.70 on five."""
    base = [f"t{i}" for i in range(60)]
    two, one = list(base), list(base)
    two[20], two[40], one[30] = "x", "y", "z"
    rows = [(1, " ".join(base)), (2, " ".join(two)), (3, " ".join(one))]
    five = {d: {tuple(t.split()[i:i + 5]) for i in range(56)} for d, t in rows}
    alike = {(a, b) for a in five for b in five if a < b and len(five[a] & five[b]) >= 0.8 * len(five[a] | five[b])}
    assert alike == {(1, 3)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == {1, 2}
    assert {r["doc_id"] for r in minhash.near_duplicates(docs, width=2).where("kept").collect()} == {1}


def test_one_document_of_each_group_stays(spark):
    """Null ids and ids that several texts have: one (id, text) of each group, none of the groups lost."""
    near = lambda c: [" ".join([f"{c}{i}" for i in range(60)] + [f"{c}end{j}"]) for j in range(3)]
    a, b, c, d = map(near, "abcd")
    rows = [(None, t) for t in a] + [(7, b[0]), (7, b[1]), (8, b[2])] + [(None, c[0]), (9, c[1])] + [(7, d[0]), (7, d[0]), (7, d[1])] + [(None, "alone here"), (None, "")]
    kept = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()]
    groups = Counter("" if not t else t[0] + ("lone" if t.startswith("alone") else "") for _, t in kept)
    assert groups == {"a": 1, "b": 1, "c": 1, "d": 1, "alone": 1, "": 1} and set(kept) <= set(rows)
    assert (9, c[1]) in kept and all(i == 7 for i, t in kept if t and t[0] in "bd")


def test_rows_of_one_document_differ_elsewhere(spark):
    """Columns that are maps, and copies that differ in their source: one row of each id and text stays, the same on every run."""
    docs = spark.sql("""SELECT * FROM VALUES (1L, 'some words of a text here', 'b', map('k', 1)), (1L, 'some words of a text here', 'a', map('k', 2)), (1L, 'some words of a text here', 'a', null),
        (2L, 'entirely other things are said', 'c', map()), (null, 'and one without id', null, map('z', 0)), (null, 'and one without id', 'x', map('z', 0)) AS t(doc_id, text, source, more)""")
    runs = [sorted((r["doc_id"] or 0, r["source"] or "", str(r["more"])) for r in corpus_pipeline.near_duplicates(spark, d, "").collect()) for d in (docs, docs.repartition(5))]
    assert runs[0] == runs[1] and [r[0] for r in runs[0]] == [0, 1, 2]
    assert corpus_pipeline.near_duplicates(spark, docs, "").schema.names == ["doc_id", "text", "source", "more"]


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF)
    assert 0 < out.count() < common.table(spark, SF, "documents").count()
    assert hashlib and decontam
