"""Exact quantiles of large columns with bounded memory.

``percentile`` keeps every distinct value in one aggregate buffer. Here a
bounded sketch brackets each quantile first; a second pass counts the rows below
each bracket and sorts only the values inside it (a few in ten thousand rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from hangarflow.operators.ordered import names

ACCURACY = 10000


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by=(), accuracy: int = ACCURACY) -> DataFrame:
    """Per group, an array of linearly interpolated quantiles for each column.

    ``by`` must be category columns with a fixed list of values (sensor types,
    classes): their brackets are broadcast.
    """
    by = names(by) if by else []
    src = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    margin = 2.0 / accuracy  # twice the sketch's rank error
    small = 5 * accuracy  # below this the brackets would be a few ranks wide: sort the whole column
    sides = [min(1.0, max(0.0, p + d)) for p in probs for d in (-margin, margin)]
    sketch = F.struct(*[
        F.struct(F.count(c).alias("n"), F.percentile_approx(c, sides, accuracy).alias("b")).alias(c) for c in cols
    ]).alias("_s")
    if by:
        # Groups come from a fixed list, so the sketch has a bounded number of rows.
        known = src.join(src.groupBy(*by).agg(sketch), by)
    else:
        known = src.withColumn("_s", src.agg(sketch).scalar())

    # One struct per (column, quantile) a row matters to; a row below the bracket
    # only counts, so its value is dropped and it collapses map-side.
    def spot(c: str, i: int) -> str:
        p, s = probs[i], f"_s.`{c}`"
        wide = f"{s}.n > {small}"
        low = f"IF({wide}, {s}.b[{2 * i}], NULL)" if p > margin else "CAST(NULL AS DOUBLE)"
        high = f"IF({wide}, {s}.b[{2 * i + 1}], NULL)" if p < 1 - margin else "CAST(NULL AS DOUBLE)"
        return (
            f"CASE WHEN `{c}` IS NOT NULL AND coalesce(`{c}` <= {high}, true) THEN named_struct('c', '{c}', 'i', {i}, "
            f"'pos', ({s}.n - 1) * {float(p)!r}D, 'v', IF(coalesce(`{c}` < {low}, false), NULL, `{c}`)) END"
        )

    spots = ", ".join(spot(c, i) for c in cols for i in range(len(probs)))
    inside = known.select(*by, F.expr(f"explode(array({spots})) AS s")).where("s IS NOT NULL")  # a filter of the array isn't compiled
    # Prefixed names: user columns may be called c, i, v or k.
    cell = ["_q_c", "_q_i"]
    counted = inside.groupBy(
        *by, F.col("s.c").alias("_q_c"), F.col("s.i").alias("_q_i"), F.col("s.pos").alias("_q_pos"), F.col("s.v").alias("_q_v")
    ).agg(F.count(F.lit(1)).alias("_q_n"))
    run = Window.partitionBy(*by, *cell).orderBy(F.asc_nulls_first("_q_v")).rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("_q_upto", F.sum("_q_n").over(run))

    def at(rank):
        return F.max(F.when((rank >= F.col("_q_upto") - F.col("_q_n")) & (rank < F.col("_q_upto")), F.col("_q_v")))

    solved = placed.groupBy(*by, *cell).agg(
        at(F.floor("_q_pos")).alias("_q_lo"), at(F.ceil("_q_pos")).alias("_q_hi"), F.first("_q_pos").alias("_q_pos"))
    value = F.col("_q_lo") + (F.col("_q_hi") - F.col("_q_lo")) * (F.col("_q_pos") - F.floor("_q_pos"))
    return solved.groupBy(*by).agg(*[
        F.transform(F.sort_array(F.collect_list(F.when(F.col("_q_c") == c, F.struct("_q_i", value.alias("v"))))),
                    lambda s: s.v).alias(c) for c in cols
    ])
