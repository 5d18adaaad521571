"""Chat formatting by schema fingerprints.

A mapping says which nested field paths it reads and how they make turns (role, text). The fingerprint of a layout is the hash of
its paths; a record has the layout if the paths it shares with it have the same hash, so fields that no mapping
reads (ids, sources, tool data) change nothing. Of several layouts the one with the most paths is taken, of equally many the
first listed. Table rows carry their paths in the schema of the table: their layout is found once, when the query is
planned, and its mapping reads the columns. JSON records are parsed to variants, and each one's paths are looked up.
``template`` then writes the turns of a conversation between control strings. Control strings inside
texts are escaped: a backslash goes between the two characters that every control string starts with, and
``unescape`` takes it out again.

Null texts and roles are empty. Turns are ordered by turn number (null last), place in the record, role
and text; repeated rows are repeated turns. Rows without conversation id are one conversation. An empty array has every path below it, so
a record with an empty list of messages has that layout and no turns; a field that is null is there. Records
of unknown layout, or that aren't JSON, have no turns and layout null; so have JSON records too large for
a variant (a text over about 20 million characters), but not table rows, which are never JSON. An empty table gives no
conversation. Extra columns are ignored; ``canonical`` carries them along, but for those named layout or turns (in any case), whose
place its own take.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from hangarflow.llm.common import pick, query, table

START, END, NEWLINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"
TURNS = "array<struct<role: string, text: string>>"
#: Layout: what makes its turns. Either an array of messages with the names of role and text, or the turns one by one, each
#: of the texts (joined by an empty line) of one role; a role that is a tuple is read from that field.
LAYOUTS = {
    "row": [(("role",), ["text"])],
    "messages": ("messages", "role", "content"),
    "messages_text": ("messages", "role", "text"),
    "from_value": ("conversations", "from", "value"),
    "instruction": [("user", ["instruction"]), ("assistant", ["output"])],
    "instruction_input": [("user", ["instruction", "input"]), ("assistant", ["output"])],
    "completion": [("user", ["prompt"]), ("assistant", ["completion"])],
    "response": [("user", ["prompt"]), ("assistant", ["response"])],
    "system_response": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])],
    "question": [("user", ["question"]), ("assistant", ["answer"])],
}
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def layout_paths(how) -> list[str]:
    """The nested field paths that a mapping reads, in order; [] marks the elements of an array."""
    if isinstance(how, tuple):
        return sorted(f"{how[0]}[].{field}" for field in how[1:])
    return sorted({path for role, paths in how for path in [*paths, *(role if isinstance(role, tuple) else ())]})


def fingerprint(paths: list[str]) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


#: The layouts, those of more paths first.
BY_SIZE = sorted(LAYOUTS, key=lambda name: -len(layout_paths(LAYOUTS[name])))


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """The nested field paths of a type."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return [at]


def schema_layout(kind: T.StructType) -> str | None:
    """The layout of rows of a table, from its schema alone."""
    own = set(schema_paths(kind))
    return next((name for name in BY_SIZE if fingerprint(own & set(layout_paths(LAYOUTS[name]))) == fingerprint(layout_paths(LAYOUTS[name]))), None)


def _has(path: str) -> Column:
    """Whether the variant has a field path."""
    if "[]." not in path:
        return F.try_variant_get("_v", f"$.{path}", "variant").isNotNull()
    array, field = path.split("[].")
    items = F.try_variant_get("_v", f"$.{array}", "array<variant>")
    return F.coalesce((F.size(items) == 0) | F.exists(items, lambda x: F.try_variant_get(x, f"$.{field}", "variant").isNotNull()), F.lit(False))


def record_layout() -> Column:
    """The layout of the variant: for each one, the paths that the record shares with it are hashed."""
    known = sorted({p for how in LAYOUTS.values() for p in layout_paths(how)})
    there = F.filter(F.array(*[F.when(_has(p), F.lit(p)) for p in known]), lambda p: p.isNotNull())
    shared = lambda t, paths: F.md5(F.array_join(F.filter(F.array(*map(F.lit, paths)), lambda p: F.array_contains(t, p)), "\n").cast("binary"))

    def pick(t: Column) -> Column:
        return F.coalesce(*[F.when(shared(t, layout_paths(LAYOUTS[n])) == fingerprint(layout_paths(LAYOUTS[n])), F.lit(n)) for n in BY_SIZE])

    return F.transform(F.array(there), pick)[0]  # so the paths are looked up once


def _turns(how, field, items) -> Column:
    """The turns by a mapping; ``field`` gives the text of a path, ``items`` an array of (role, text) fields."""
    if isinstance(how, tuple):
        _, role, text = how
        made = F.transform(items(how), lambda x: F.struct(_role(F.coalesce(x[role], F.lit(""))).alias("role"), F.coalesce(x[text], F.lit("")).alias("text")))
    else:
        joined = lambda paths: F.array_join(F.filter(F.array(*map(field, paths)), lambda s: s != ""), "\n\n")
        made = F.array(*(F.struct((field(role[0]) if isinstance(role, tuple) else F.lit(role)).alias("role"), joined(paths).alias("text")) for role, paths in how))
    return made.cast(TURNS)


def _role(c: Column) -> Column:
    out = c
    for other, own in ROLES.items():
        out = F.when(c == other, own).otherwise(out)
    return out


def canonical(records: DataFrame, record: str = "record") -> DataFrame:
    """``records`` with layout (null: unknown) and turns; ``record`` holds the JSON text."""
    names = records.columns
    plain = [f"_{i}" for i in range(len(names))]
    kept = [p for p, n in zip(plain, names) if n.lower() not in ("layout", "turns")]
    out = records.toDF(*plain).withColumn("_v", F.try_parse_json(plain[names.index(record)])).withColumn("_layout", record_layout())
    field = lambda path: F.coalesce(F.try_variant_get("_v", f"$.{path}", "string"), F.lit(""))
    items = lambda how: F.try_variant_get("_v", f"$.{how[0]}", f"array<struct<`{how[1]}`: string, `{how[2]}`: string>>")
    turns = F.array().cast(TURNS)
    for name, how in LAYOUTS.items():
        turns = F.when(F.col("_layout") == name, _turns(how, field, items)).otherwise(turns)
    return out.select(*kept, "_layout", F.coalesce(turns, F.array().cast(TURNS))).toDF(*[names[plain.index(p)] for p in kept], "layout", "turns")


def canonical_rows(rows: DataFrame) -> DataFrame:
    """``rows`` with turns, by the layout that their schema has; ValueError if it has none."""
    name = schema_layout(rows.schema)
    if name is None:
        raise ValueError(f"no layout reads {rows.schema.simpleString()}")
    field = lambda path: F.coalesce(F.col(f"`{path}`").cast("string"), F.lit(""))
    return rows.select("*", _turns(LAYOUTS[name], field, lambda how: F.col(f"`{how[0]}`")).alias("turns"))


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def template(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, spans) of turns (conv_id, turn, at, role, text).

    spans: text of the assistant, by turn (from 0), place in formatted (start, from 0), place in the
    turn's own piece (inner) and length. Places come from a running sum over the turns.
    """
    piece = F.concat(F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit(NEWLINE)), F.lit("\n"), escape(F.col("text")), F.lit(END))
    own = Window.partitionBy("conv_id").orderBy(F.asc_nulls_last("turn"), "at", "role", "text")
    rows = turns.withColumn("piece", piece).withColumn("n", F.row_number().over(own) - 1)
    length = F.length(escape(F.col("text"))).cast("long")
    rows = rows.withColumn("start", F.sum(F.length("piece").cast("long")).over(own.rowsBetween(Window.unboundedPreceding, 0)) - len(END) - length)
    rows = rows.select("conv_id", "n", "piece", F.when(F.col("role") == "assistant", F.struct(
        F.col("n").alias("turn"), "start", (F.length("piece") - len(END) - length).alias("inner"), length.alias("length"))).alias("span"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("n", "piece", "span"))).alias("p")).select(
        "conv_id", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"),
        F.filter(F.transform("p", lambda x: x["span"]), lambda s: s.isNotNull()).alias("spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss, formatted): what ``template`` was given, and the text under the loss spans."""
    cut = formatted.withColumn("pieces", F.slice(F.split("formatted", START.replace("|", r"\|"), -1), 2, 2_000_000_000))
    role = lambda x: F.substring_index(x, "\n", 1)
    turns = F.transform("pieces", lambda x: F.struct(
        unescape(F.replace(role(x), F.lit(NEWLINE), F.lit("\n"))).alias("role"),
        unescape(F.substring(x, F.length(role(x)) + 2, F.length(x) - F.length(role(x)) - 1 - len(END))).alias("text")))
    loss = F.transform("spans", lambda s: unescape(F.substring(F.get("pieces", s["turn"]), (s["inner"] - len(START) + 1).cast("int"), s["length"].cast("int"))))
    return cut.select("conv_id", turns.alias("turns"), F.array_join(loss, "").alias("loss"), "formatted")


def conversation_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, at, role, text) of rows (conv_id, turn, role, text): the mapping of the schema's layout makes each row's turns."""
    made = canonical_rows(pick(rows, "conv_id", "turn", "role", "text"))
    return made.select("conv_id", "turn", F.posexplode("turns").alias("at", "t")).select("conv_id", "turn", "at", "t.role", "t.text")


PROBE = "<|im_end|><|im_start|>assistant ok"


@query("op7_chat_format", rf"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')),
e AS (SELECT *, length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + length(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '<|nl|>')) AS n FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(n + {len(START) + 1 + len(END)})::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""")
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(PROBE))
    out = read_back(template(conversation_turns(rows.union(probe))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
