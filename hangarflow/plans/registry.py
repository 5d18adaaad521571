"""Registration of catalogue queries and the common output form."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
EPS = 1e-9


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, dates and times as text: the same in any engine.

    The tiny shift settles values that lie exactly between two roundings, where
    a last-bit difference in a sum would otherwise decide.
    """
    cols, unit, half = [], 10 ** digits, 0.5 / 10 ** digits
    for f in df.schema.fields:
        c = f"`{f.name}`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            d = f"CAST({c} AS DOUBLE)"
            # Tiny values become a plain zero, never a negative one.
            c = f"CASE WHEN abs({d}) < {half}D THEN 0D ELSE rint(({d} + {EPS}D) * {unit}D) / {unit}D END"
        elif isinstance(f.dataType, T.DateType):
            c = f"date_format({c}, 'yyyy-MM-dd')"
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = f"date_format({c}, '{TIME_TEXT}')"
        cols.append(f"{c} AS `{f.name}`")
    return df.selectExpr(*cols)


def query(name: str, sql: str | None = None):
    def add(fn):
        @wraps(fn)
        def run(spark, sf_dir):
            return present(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql:
            SQL[name] = sql.strip()
        return fn

    return add


def out(body: str, dbl: str = "", date: str = "", ts: str = "", big: str = "", views: str = "") -> str:
    """SQL counterpart of :func:`present`; ``views`` is a list of named CTEs."""
    rep = [f"CASE WHEN abs({c}::DOUBLE) < 5e-7 THEN 0.0 ELSE round({c}::DOUBLE + 1e-9, 6) END AS {c}" for c in dbl.split()]
    rep += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in date.split()]
    rep += [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in ts.split()]
    rep += [f"{c}::BIGINT AS {c}" for c in big.split()]
    star = f"* REPLACE ({', '.join(rep)})" if rep else "*"
    text = f"SELECT {star} FROM ({body.strip()}) AS answer"
    return f"WITH {with_views(views)}\n{text}" if views else text


def with_views(wanted: str) -> str:
    from hangarflow.plans.sql_views import VIEWS

    picked: list[str] = []

    def add(name: str) -> None:
        if name in picked:
            return
        for other in VIEWS[name][0].split():
            add(other)
        picked.append(name)

    for name in wanted.split():
        add(name)
    return ",\n".join(f"{n} AS ({VIEWS[n][1].strip()})" for n in picked)
