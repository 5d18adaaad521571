"""Ordered scans per entity that survive one entity holding most of the rows.

A plain ``Window.partitionBy(entity).orderBy(time)`` sorts a whole entity in one
task. For raw readings that is not safe, so each scan here runs on two levels:
rows are cut into (entity, time bucket) chunks, every chunk is summarised by a
partial aggregate, the summaries (at most one per bucket of calendar time) are
scanned per entity, and the result is handed to the rows of the next chunk.
``width`` is the bucket size: seconds for timestamps, days for dates, units for
numbers. ``width=None`` is for inputs with at most one row per entity and
calendar slot, where the plain window is already bounded.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

CHUNK = "_chunk"
HOUR = 3600
DAY = 86400


def names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def spread(df: DataFrame, by) -> DataFrame:
    """Partition by entity into as many parts as the session asks for.

    Wide window sets cost far more CPU than bytes, and adaptive execution merges
    partitions by bytes; a stated number keeps them apart.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *names(by))


def bucket(df: DataFrame, ts: str, width: int) -> Column:
    """Bucket number of ``ts``, by its type."""
    kind = df.schema[ts].dataType
    if isinstance(kind, T.DateType):
        number = F.unix_date(ts)
    elif isinstance(kind, T.TimestampType):
        number = F.unix_seconds(ts)
    elif isinstance(kind, T.NumericType):
        number = F.col(ts)
    else:
        raise TypeError(f"cannot bucket {ts} of type {kind.simpleString()}")
    return F.floor(number / F.lit(width)).cast("long")


def _scan(by: Sequence[str], sort: Sequence[str], forward: bool, inclusive: bool):
    """The frame of the rows before (or after) a row. Rows after it are read in reversed order: a frame that only grows is scanned once, one that shrinks from the front is read anew for each row."""
    order = [F.desc_nulls_last(c) for c in sort] if forward else sort
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)


def nearest_seen(
    df: DataFrame,
    by: str | Sequence[str],
    ts: str,
    values: Mapping[str, tuple[Column, Column]],
    order: Sequence[str] = (),
    width: int | None = None,
    forward: bool = False,
    inclusive: bool = True,
) -> DataFrame:
    """Add, per output name, the value of the nearest earlier (or later) valid row.

    ``values`` maps output name -> (value, validity). ``order`` breaks ties in ``ts``.
    """
    by = names(by)
    sort = [ts, *order]
    if width is None:
        w = _scan(by, sort, forward, inclusive)
        return df.select("*", *[
            F.last(F.when(ok, value), ignorenulls=True).over(w).alias(out)
            for out, (value, ok) in values.items()
        ])

    chunked = df.withColumn(CHUNK, bucket(df, ts, width))
    rank = F.struct(*sort)
    best = F.min_by if forward else F.max_by
    summary = chunked.groupBy(*by, CHUNK).agg(*[
        best(value, F.when(ok, rank)).alias(f"_edge_{out}") for out, (value, ok) in values.items()
    ])
    across = _scan(by, [CHUNK], forward, False)
    summary = summary.select(*by, CHUNK, *[
        F.last(f"_edge_{out}", ignorenulls=True).over(across).alias(f"_edge_{out}") for out in values
    ])
    within = _scan([*by, CHUNK], sort, forward, inclusive)
    joined = chunked.join(summary, [*by, CHUNK], "left")
    return joined.select(*df.columns, *[
        F.coalesce(F.last(F.when(ok, value), ignorenulls=True).over(within), F.col(f"_edge_{out}")).alias(out)
        for out, (value, ok) in values.items()
    ])


def previous(df, by, ts, columns: Mapping[str, str], order=(), width=None) -> DataFrame:
    """``lag`` by one row; ``columns`` maps output name -> source column."""
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns.values())])
    seen = nearest_seen(df, by, ts, {"_prev": (row, F.lit(True))}, order, width, inclusive=False)
    return seen.select(*df.columns, *[
        F.col(f"_prev.c{i}").alias(out) for i, out in enumerate(columns)
    ])


def running(df, by, ts, sums: Mapping[str, Column], order=(), width=None) -> DataFrame:
    """Running totals including the current row."""
    by = names(by)
    sort = [ts, *order]
    if width is None:
        w = Window.partitionBy(*by).orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(v).over(w).alias(out) for out, v in sums.items()])
    chunked = df.withColumn(CHUNK, bucket(df, ts, width))
    summary = chunked.groupBy(*by, CHUNK).agg(*[F.sum(v).alias(f"_sum_{o}") for o, v in sums.items()])
    across = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*by, CHUNK, *[F.sum(f"_sum_{o}").over(across).alias(f"_sum_{o}") for o in sums])
    within = Window.partitionBy(*by, CHUNK).orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    return chunked.join(summary, [*by, CHUNK], "left").select(*df.columns, *[
        (F.coalesce(F.col(f"_sum_{o}"), F.lit(0)) + F.coalesce(F.sum(v).over(within), F.lit(0))).alias(o)
        for o, v in sums.items()
    ])


def row_index(df, by, ts, out: str, order=(), width=None, start: int = 1) -> DataFrame:
    """Position of the row inside its entity, counted from ``start``."""
    numbered = running(df, by, ts, {out: F.lit(1).cast("long")}, order, width)
    return numbered.withColumn(out, F.col(out) + F.lit(start - 1).cast("long"))


def per_entity(df: DataFrame, by, stats: Mapping[str, Column]) -> DataFrame:
    """Attach per-entity aggregates.

    A partial aggregate and an equi-join instead of an unordered window: the
    aggregate combines map-side, the join may be broadcast by measured size, and
    a hot entity is split by adaptive skew handling.
    """
    by = names(by)
    side = df.groupBy(*by).agg(*[c.alias(o) for o, c in stats.items()])
    return df.join(side, by, "left")


def global_running(df: DataFrame, key: str, totals: Sequence[str], parts: int = 64, descending: bool = False) -> DataFrame:
    """Running totals over a global order of ``key`` without a one-task sort.

    ``df`` must hold one row per key value (pre-aggregate first). Keys are cut
    into about equal ranges at approximate quantiles; only the per-range sums
    (at most ``parts`` rows) are scanned in one task. Adds ``cum_<total>``.
    """
    parts = max(parts, 2)
    cuts = df.agg(
        F.percentile_approx(key, [i / parts for i in range(1, parts)], 10000).alias("cuts")
    ).scalar()
    chunked = (
        df.withColumn("_cuts", cuts)
        .withColumn(CHUNK, F.size(F.filter("_cuts", lambda c: c < F.col(key))))
        .drop("_cuts")
    )
    sort = F.col(key).desc() if descending else F.col(key).asc()
    outer = F.col(CHUNK).desc() if descending else F.col(CHUNK).asc()
    across = Window.orderBy(outer).rowsBetween(Window.unboundedPreceding, -1)
    sums = chunked.groupBy(CHUNK).agg(*[F.sum(t).alias(f"_sum_{t}") for t in totals])
    before = sums.select(CHUNK, F.struct(*[F.sum(f"_sum_{t}").over(across).alias(t) for t in totals]).alias("_o"))
    # At most `parts` entries, handed over as one map value.
    offsets = before.agg(F.map_from_entries(F.collect_list(F.struct(CHUNK, "_o"))).alias("m")).scalar()
    within = Window.partitionBy(CHUNK).orderBy(sort).rowsBetween(Window.unboundedPreceding, 0)
    running_ = chunked.select("*", *[F.sum(t).over(within).alias(f"_run_{t}") for t in totals]).withColumn("_m", offsets)
    here = F.try_element_at("_m", F.col(CHUNK))
    return running_.select(*df.columns, *[
        (F.coalesce(here[t], F.lit(0)) + F.col(f"_run_{t}")).alias(f"cum_{t}") for t in totals
    ])
