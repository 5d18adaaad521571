"""Licence recognition from known sentences and ordered rules.

A text is cut into sentences, each is normalised (A-Z in lower case, marks of ASCII and white space as
one space) and looked up among the known licence sentences. A document so becomes a string of one
code per sentence, and a rule is a sequence of codes with at most ``gap`` other sentences between two of
them. Licence texts are usually wrapped, often in comment blocks, so there are two readings: with each line's end
a sentence's end, and with comment marks taken away and paragraphs put on one line. A rule that holds in the first isn't looked for in
the second. All of it works within a row: no shuffle, no join.

Null and empty texts have no sentence and no licence. Repeated rows and repeated or null ids each give a
row of their own. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hangarflow.llm.common import LOWER, UPPER, pick, query, table, text_or_empty

# Sentences of well-known licences and notices, normalised.
SENTENCES = [
    ("mit-notice", "released under the mit license"),
    ("mit-notice-2", "licensed under the mit license"),
    ("mit-title", "mit license"),
    ("mit-title-2", "the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit-keep", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-as-is", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit-liability", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("apache-notice", "licensed under the apache license version 2 0"),
    ("apache-notice-2", "licensed under the apache license version 2 0 the license"),
    ("apache-title", "apache license"),
    ("apache-use", "you may not use this file except in compliance with the license"),
    ("apache-copy", "you may obtain a copy of the license at"),
    ("apache-as-is", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-see", "see the license for the specific language governing permissions and limitations under the license"),
    ("gpl3-notice", "this work is licensed under the gnu general public license version 3"),
    ("gpl-free", "this program is free software"),
    ("gpl3-may", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl2-may", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-hope", "this program is distributed in the hope that it will be useful but without any warranty"),
    ("gpl-implied", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl-details", "see the gnu general public license for more details"),
    ("bsd-forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-endorse", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("mpl-notice", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-notice", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa-notice", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc-short", "licensed under cc by nc 4 0"),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("reserved", "all rights reserved"),
]
# Licence, the sentences that show it in this order, most other sentences between two of them.
RULES = [
    ("MIT", ["mit-notice"], 0), ("MIT", ["mit-notice-2"], 0), ("MIT", ["mit-grant", "mit-keep"], 1), ("MIT", ["mit-grant", "mit-as-is"], 2),
    ("Apache-2.0", ["apache-notice"], 0), ("Apache-2.0", ["apache-notice-2", "apache-use"], 1), ("Apache-2.0", ["apache-use", "apache-copy", "apache-as-is"], 3),
    ("GPL-3.0", ["gpl3-notice"], 0), ("GPL-3.0", ["gpl-free", "gpl3-may"], 0), ("GPL-2.0", ["gpl-free", "gpl2-may"], 0),
    ("BSD-3-Clause", ["bsd-forms", "bsd-source", "bsd-binary", "bsd-endorse"], 3), ("BSD-2-Clause", ["bsd-forms", "bsd-source", "bsd-binary"], 3),
    ("MPL-2.0", ["mpl-notice"], 0), ("CC-BY-4.0", ["cc-by-notice"], 0), ("CC-BY-SA-4.0", ["cc-by-sa-notice"], 0),
    ("CC-BY-NC-4.0", ["cc-by-nc-short"], 0), ("ISC", ["isc-grant"], 0), ("Unlicense", ["unlicense"], 0), ("proprietary", ["reserved"], 0),
]
# Titles, the GPL's notice with a semicolon inside, the head of the Apache licence.
SENTENCES += [
    ("mit-title-3", "the mit license mit"),
    ("apache-version", "version 2 0 january 2004"),
    ("apache-head", "apache license version 2 0 january 2004 http www apache org licenses"),
    ("gpl-terms", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl2-either", "either version 2 of the license or at your option any later version"),
    ("gpl3-either", "either version 3 of the license or at your option any later version"),
    ("bsl-grant", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"),
    ("zlib-warranty", "this software is provided as is without any express or implied warranty"),
    ("zlib-grant", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("0bsd-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("wtfpl", "do what the fuck you want to public license"),
    ("epl-notice", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0"),
    ("cc0-notice", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
]
RULES += [
    ("MIT", ["mit-title"], 0), ("MIT", ["mit-title-2"], 0), ("MIT", ["mit-title-3"], 0),
    ("Apache-2.0", ["apache-title", "apache-version"], 0), ("Apache-2.0", ["apache-head"], 0),
    ("GPL-2.0", ["gpl-free", "gpl-terms", "gpl2-either"], 0), ("GPL-3.0", ["gpl-free", "gpl-terms", "gpl3-either"], 0),
    ("BSL-1.0", ["bsl-grant"], 0), ("Zlib", ["zlib-warranty", "zlib-grant"], 2), ("0BSD", ["0bsd-grant"], 0),
    ("WTFPL", ["wtfpl"], 0), ("EPL-2.0", ["epl-notice"], 0), ("CC0-1.0", ["cc0-notice"], 0),
]
# Identifiers of the public licence list that file headers name.
IDENTIFIERS = """0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0 Artistic-2.0 Beerware BlueOak-1.0.0
BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0
CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2
GFDL-1.3 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0
LGPL-3.0-only LGPL-3.0-or-later LPPL-1.3c MIT MIT-0 MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1
OpenSSL OSL-3.0 PHP-3.01 PostgreSQL Python-2.0 QPL-1.0 Ruby SSPL-1.0 Unicode-3.0 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1""".split()


def identifier(name: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in name.lower()).split())


SENTENCES += [("spdx", "spdx license identifier")] + [(f"id-{n}", identifier(n)) for n in IDENTIFIERS]
RULES += [(n, ["spdx", f"id-{n}"], 0) for n in IDENTIFIERS]
#: One character for each sentence, of those for private use; a dot stands for a sentence that isn't known.
CODES = "." + "".join(map(chr, range(0xE000, 0xF900)))
BREAK, CUT = r"[.!?;:]+[ \t\r\n]+|[\n|]+", " ?[|]+ ?"
COMMENT, COMMENT_END = r"^[ \t]*(?:[/][/]+|[/][*]+|[*]+[/]|[*]+|#+|;+|--+|<!--|%+|(?:dnl|rem)\b)?[ \t]*", r"[ \t]*(?:[*]+[/]|-->)?[ \t]*$"
VERSION = r"(^|[^A-Za-z])([vV])[.] ([0-9])"
MARKS = "\t\r!\"#$%&'()*+,-./:;<=>?@[\\]^_`{}~"
FROM, TO = UPPER + MARKS, LOWER + " " * len(MARKS)


def sentences(text: Column) -> Column:
    """The normalised sentences, without empty ones."""
    marked = F.regexp_replace(F.translate(F.regexp_replace(text, BREAK, "|"), FROM, TO), " {2,}", " ")
    return F.filter(F.split(F.btrim(marked, F.lit(" |")), CUT, -1), lambda s: s != "")


def unwrapped(text: Column) -> Column:
    """Paragraphs on one line, without the marks of comments, a bar between paragraphs; ``v. 2`` doesn't end a sentence."""
    lines = F.regexp_replace(text, r"\r\n?", "\n")
    plain = F.regexp_replace(F.regexp_replace(lines, f"(?imd){COMMENT}", ""), f"(?md){COMMENT_END}", "")
    return F.regexp_replace(F.translate(F.regexp_replace(plain, r"\n\n+", "|"), "\n", " "), VERSION, "$1$2 $3")


def code_string(found: Column, known: list[tuple[str, str]]) -> Column:
    if len(known) >= len(CODES):
        raise ValueError(f"at most {len(CODES) - 1} sentences")
    texts = F.array(*(F.lit(s) for _, s in known))
    one = lambda s: F.substring(F.lit(CODES[:len(known) + 1]), F.array_position(texts, s).cast("int") + 1, F.lit(1))
    return F.array_join(F.transform(found, one), "")


def rule_pattern(ids: list[str], gap: int, known: list[tuple[str, str]]) -> str:
    at = {name: CODES[i] for i, (name, _) in enumerate(known, 1)}
    return f".{{0,{gap}}}".join(at[i] for i in ids)


def anchor(known: list[tuple[str, str]], rules: list[tuple[str, list[str], int]]) -> str:
    """A pattern of few words, one of which is in some sentence of every rule: no rule holds for a text without them."""
    text = dict(known)
    left, words = [{w for i in ids for w in text[i].split()} for _, ids, _ in rules], []
    while left:
        word = max(sorted(set().union(*left)), key=lambda w: (len(w) > 5, sum(w in s for s in left), len(w)))  # short words are in every text
        words.append(word)
        left = [s for s in left if word not in s]
    return "(?i)(?<![a-z0-9])(?:" + "|".join(words) + ")(?![a-z0-9])"


def places(codes: str, pattern: str, name: str) -> Column:
    """(license, first, sentences) of each place, from the left, where the pattern stands in the string of codes; places don't overlap."""
    p = F.lit(pattern)
    found, between = F.regexp_extract_all(codes, p, F.lit(0)), F.split(codes, pattern, -1)
    before = lambda a, n: F.aggregate(F.slice(a, F.lit(1), n), F.lit(0), lambda s, x: s + F.length(x))
    one = lambda m, i: F.struct(F.lit(name).alias("license"), (before(between, i + 1) + before(found, i)).alias("first"), F.length(m).alias("sentences"))
    return F.when(F.col(codes).rlike(pattern), F.transform(found, one))


def scan(docs: DataFrame, known: list[tuple[str, str]] = SENTENCES, rules: list[tuple[str, list[str], int]] = RULES) -> DataFrame:
    """(doc_id, codes, found): found lists (license, first, sentences), all places of each rule, counted in sentences from 0.

    ``codes`` takes each line's end for a sentence's end. A rule that doesn't hold there is tried on the text with its
    paragraphs unwrapped, and its places are counted in the sentences of that. Texts without the words that every rule needs aren't unwrapped.
    """
    text = text_or_empty()
    other = F.when(text.rlike(anchor(known, rules)), unwrapped(text)).otherwise("")
    coded = pick(docs, "doc_id", "text").select("doc_id", code_string(sentences(text), known).alias("codes"), code_string(sentences(other), known).alias("_unwrapped"))
    hits = [F.coalesce(*(places(c, rule_pattern(ids, gap, known), name) for c in ("codes", "_unwrapped"))) for name, ids, gap in rules]
    none = F.array().cast("array<struct<license: string, first: int, sentences: int>>")
    some = F.flatten(F.filter(F.array(*hits), lambda h: h.isNotNull()))
    return coded.select("doc_id", "codes", F.when(F.concat("codes", "_unwrapped").rlike("[^.]"), some).otherwise(none).alias("found"))


def _oracle() -> str:
    known = ", ".join(f"'{s}'" for _, s in SENTENCES)
    rules = ",\n    ".join(f"CASE WHEN regexp_matches(codes, '{p}') OR regexp_matches(other, '{p}') THEN '{n}' END"
                           for n, p in ((n, rule_pattern(i, g, SENTENCES)) for n, i, g in RULES))
    norm = lambda t: (f"list_filter(regexp_split_to_array(trim(regexp_replace(translate(regexp_replace({t}, '{BREAK}', '|', 'g'), "  # noqa: E731
                      f"'{FROM.replace(chr(39), chr(39) * 2)}', '{TO}'), ' {{2,}}', ' ', 'g'), ' |'), '{CUT}'), lambda s: s <> '')")
    codes = lambda l: f"array_to_string(list_transform({l}, lambda x: substr('{CODES[:len(SENTENCES) + 1]}', coalesce(list_position([{known}], x), 0)::INT + 1, 1)), '')"
    return rf"""
WITH lines AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g') AS l FROM documents),
plain AS (SELECT doc_id, t, regexp_replace(regexp_replace(l, '(?im){COMMENT}', '', 'g'), '(?m){COMMENT_END}', '', 'g') AS p FROM lines),
flat AS (SELECT doc_id, t, regexp_replace(translate(regexp_replace(p, '\n\n+', '|', 'g'), chr(10), ' '), '{VERSION}', '\1\2 \3', 'g') AS u FROM plain),
cut AS (SELECT doc_id, {norm('t')} AS s, {norm('u')} AS o FROM flat),
coded AS (SELECT doc_id, {codes('s')} AS codes, {codes('o')} AS other FROM cut),
named AS (SELECT doc_id, codes, list_sort(list_distinct(list_filter([
    {rules}], lambda r: r IS NOT NULL))) AS l FROM coded)
SELECT doc_id, length(codes) AS n_sentences, length(replace(codes, '.', '')) AS n_known, len(l) AS n_licenses, array_to_string(l, ',') AS licenses FROM named
"""


@query("op6_license_scan", _oracle())
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array_sort(F.array_distinct(F.transform("found", lambda h: h["license"])))
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", F.length("codes").cast("long").alias("n_sentences"), F.length(F.replace("codes", F.lit("."), F.lit(""))).cast("long").alias("n_known"),
        F.size(names).cast("long").alias("n_licenses"), F.array_join(names, ",").alias("licenses"),
    )
