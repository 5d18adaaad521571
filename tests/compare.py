"""Run catalogue queries against DuckDB. As a script: python -m tests.compare SF NAME..."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, float) and math.isnan(v):
        return ("nan",)
    if isinstance(v, (dt.date, dt.datetime)):
        return ("time", str(v))
    if isinstance(v, bool):
        return ("bool", v)
    if v is None:
        return ("none",)
    return (type(v).__name__, v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([columns[i] for i in order]), sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {sorted(set(got_cols) ^ set(want_cols))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if not bad:
        return None
    g, w = bad[0]
    cells = [(c, a, b) for c, a, b in zip(got_cols, g, w) if a != b]
    return f"{len(bad)} of {len(got)} rows differ, first: {cells[:6]} in {g[:6]}"


def main(sf: str, wanted: list[str]) -> None:
    import __spark_entry__ as entry
    from hangarflow.session import build

    spark = build("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                  spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con, qs, sqls = connect(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in wanted or list(qs):
        start = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name in sqls:
                verdict = compare(df, con, sqls[name])
                kinds = "D"
            else:
                verdict, kinds = None, f"R rows={df.count()}"
        except Exception as e:  # report and go on with the next query
            verdict, kinds = f"{type(e).__name__}: {str(e)[:900]}", "?"
        bad += verdict is not None
        print(f"{'ok ' if verdict is None else 'BAD'} {name} {kinds} {time.time() - start:.1f}s {verdict or ''}", flush=True)
    print("bad:", bad)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
