"""BPE encoding and decoding with a public vocabulary of words with word ends.

Encoding: special tokens are cut out of the raw text; the rest is brought to NFC and lower case and cut
into words, each word into its UTF-8 bytes (in the vocabulary's alphabet), the last with the word end.
The symbols of a word form a doubly linked list; a heap holds the neighbours that a merge rule joins, by
rank and then place; each pop merges the two unless one of them has changed since (a stale entry).
Decoding concatenates the vocabulary strings, with a blank between two of them, as files without a
decoder ask for.

The vocabulary file is read once on the driver and broadcast: its size is fixed by the tokenizer (2 MB)
and is checked. ``ids`` are packed: 4 bytes each, little endian, unsigned. Null and empty texts have no
ids; every row, also a repeated one, is encoded by itself. Other columns are kept as they are.
"""

from __future__ import annotations

import heapq
import json
import os
import struct
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from hangarflow.llm.common import pick, query, table, text_or_empty, tokenizer_file

#: Most bytes of a vocabulary file that are broadcast.
MOST_BYTES = 64_000_000
#: Words whose ids a task remembers; beyond, it starts anew.
REMEMBER = 150_000
#: Texts whose ids and decoded text a worker holds at once.
PIECE = 256
#: White space of Unicode, which the pattern engine of the file's format knows as \s.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def load(path: str) -> dict:
    """What encoding and decoding need of a tokenizer file; refuses files of another kind."""
    if os.path.getsize(path) > MOST_BYTES:
        raise ValueError(f"{path}: over {MOST_BYTES} bytes")
    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    model = j["model"]
    kinds = [n["type"] for n in j["normalizer"]["normalizers"]], [p["type"] for p in j["pre_tokenizer"]["pretokenizers"]]
    if model["type"] != "BPE" or kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) or j["decoder"] or model["byte_fallback"]:
        raise ValueError(f"{path}: not a BPE file of words with word ends")
    vocab = model["vocab"]
    merges = {}
    for rank, (a, b) in enumerate(model["merges"]):
        merges[vocab[a], vocab[b]] = rank, vocab[a + b]
    strings = {i: s for s, i in vocab.items()} | {t["id"]: t["content"] for t in j["added_tokens"]}
    return {
        "vocab": vocab, "merges": merges, "strings": strings, "end": model["end_of_word_suffix"] or "",
        "special": {t["content"]: t["id"] for t in j["added_tokens"]},
        "pattern": j["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", SPACE),
    }


def byte_letters() -> list[str]:
    """The letter of each byte: visible ones stand for themselves, the others follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in own:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


def merge_word(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The ids left when no rule joins two neighbours any more; the lowest rank goes first, then the leftmost."""
    n = len(symbols)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = []
    for i in range(n - 1):
        rule = merges.get((symbols[i], symbols[i + 1]))
        if rule:
            heap.append((rule[0], i, symbols[i], symbols[i + 1]))
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j < 0 or symbols[j] != right:
            continue  # stale: one of the two has been merged since
        symbols[i], symbols[j] = merges[left, right][1], -1
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            rule = merges.get((symbols[i], symbols[k]))
            if rule:
                heapq.heappush(heap, (rule[0], i, symbols[i], symbols[k]))
        k = before[i]
        if k >= 0:
            rule = merges.get((symbols[k], symbols[i]))
            if rule:
                heapq.heappush(heap, (rule[0], k, symbols[k], symbols[i]))
    return [s for s in symbols if s >= 0]


class Encoder:
    """Text to packed ids, remembering words."""

    def __init__(self, tokenizer: dict):
        import regex

        self.t, self.letters, self.known = tokenizer, byte_letters(), {}
        self.words = regex.compile(tokenizer["pattern"]).findall
        special = sorted(tokenizer["special"], key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def word(self, word: str) -> bytes:
        vocab, end = self.t["vocab"], self.t["end"]
        letters = [self.letters[b] for b in word.encode("utf-8", "surrogatepass")]
        letters[-1] += end
        ids = merge_word([vocab[c] for c in letters if c in vocab], self.t["merges"])
        if len(self.known) >= REMEMBER:
            self.known.clear()
        self.known[word] = packed = struct.pack(f"<{len(ids)}I", *ids)
        return packed

    def plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # a sigma in lower case, wherever it stands
        known, new = self.known.get, self.word
        return b"".join([known(w) or new(w) for w in self.words(text.lower())])

    def __call__(self, text: str) -> bytes:
        if self.special is None or not any(s in text for s in self.t["special"]):
            return self.plain(text)
        parts = self.special.split(text)
        return b"".join(struct.pack("<I", self.t["special"][p]) if i % 2 else self.plain(p) for i, p in enumerate(parts))


def decode_ids(packed: bytes, strings: dict[int, str]) -> str:
    return " ".join([strings[i] for i in memoryview(packed).cast("I")])


def encode(spark: SparkSession, path: str | None = None):
    """A column function: text to packed ids."""
    shared = spark.sparkContext.broadcast(load(path or tokenizer_file()))

    @F.pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(shared.value)
        for texts in batches:
            yield pd.Series([encoder(t or "") for t in texts], dtype=object)

    return ids


def decode(spark: SparkSession, path: str | None = None):
    """A column function: packed ids to text."""
    shared = spark.sparkContext.broadcast(load(path or tokenizer_file())["strings"])

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        strings = shared.value
        for ids in batches:
            yield pd.Series([decode_ids(i or b"", strings) for i in ids], dtype=object)

    return text


def round_trip(spark: SparkSession, path: str | None = None):
    """A column function: text to (ids, decoded), both by one worker in one pass."""
    shared = spark.sparkContext.broadcast(load(path or tokenizer_file()))

    @F.pandas_udf("ids binary, decoded string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, strings = Encoder(shared.value), shared.value["strings"]
        for texts in batches:
            for at in range(0, len(texts), PIECE):
                ids = [encoder(t or "") for t in texts.iloc[at:at + PIECE]]
                yield pd.DataFrame({"ids": ids, "decoded": [decode_ids(i, strings) for i in ids]}, dtype=object)

    return both


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded)."""
    both = round_trip(docs.sparkSession, path)(text_or_empty()).alias("both")
    return pick(docs, "doc_id", "text").select("doc_id", both).select("doc_id", "both.ids", "both.decoded")


def digests(out: DataFrame) -> DataFrame:
    return out.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op8_bpe")
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encoded(table(spark, sf_dir, "documents")))
