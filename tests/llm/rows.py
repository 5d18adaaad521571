"""Small tables with the awkward cases: nulls everywhere, empty and long texts, ties, repeated rows, clashing extra columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TEXT_ long, v string, h string, node string, _0 string"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def texts():
    rng = random.Random(5)
    out = []
    base = words(rng, 120)
    passage = " ".join(words(rng, 90, 10_000))
    for i in range(40):
        own = words(rng, rng.choice([0, 1, 2, 3, 5, 30, 80, 200]))
        if i % 4 == 0:  # near copies
            own = list(base)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = f"x{i}{rng.randrange(50)}"
        t = " ".join(own)
        if i % 5 == 0:
            t += " " + passage + " tail" + str(i)
        if i % 3 == 0:
            t += "\nSame Line\n  sAME lINE \n\nend " + str(i % 2)
        out.append(t)
    return out + [None, None, "", "", " \t\n", "…!?", "É é ß ÉÉ", out[3], out[3], "a" * 3000, "ab" * 1500, "Word " * 4000, "<|endoftext|> it's I'LL \x1c x"]


def documents(spark, keep=None):
    rows = []
    for i, t in enumerate(texts()):
        rows.append((i, t, ["en", "de", None][i % 3], None, None if t is None else len(t), 1, "v", None, "n", "z"))
    rows += [rows[5], rows[5], (None, "no id here at all", None, None, None, None, None, None, None, None), (None, None) + (None,) * 8]
    rows = rows if keep is None else rows[:keep]
    return spark.createDataFrame(rows, SCHEMA), [(r[0], r[1]) for r in rows]
