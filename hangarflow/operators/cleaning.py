"""Filling, outlier handling, de-duplication and the cleaned (silver) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hangarflow import rules
from hangarflow.functions import scalars
from hangarflow.operators.moving import trailing_median
from hangarflow.operators.ordered import HOUR, names, nearest_seen
from hangarflow.operators.quantiles import exact_quantiles
from hangarflow.session import staged


def impute(df, cols: Sequence[str], strategy: str, by="aircraft_id", ts="date", order=(), width=None) -> DataFrame:
    """``forward_fill`` (then backward), ``interpolate``, ``mean`` or ``drop``.

    Filling never crosses entities; ``width`` switches to chunked scans for
    inputs that can hold many rows per entity and calendar slot.
    """
    if strategy == "drop":
        return df.dropna(subset=list(cols))
    if strategy == "mean":
        means = df.agg(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("m")).scalar()
        known = df.withColumn("_m", means)
        return known.select(*[
            F.coalesce(F.col(c), F.col(f"_m.{c}")).alias(c) if c in cols else F.col(c) for c in df.columns
        ])
    if strategy == "forward_fill":
        back = nearest_seen(df, by, ts, {f"_b_{c}": (F.col(c), F.col(c).isNotNull()) for c in cols}, order, width)
        both = nearest_seen(back, by, ts, {f"_f_{c}": (F.col(c), F.col(c).isNotNull()) for c in cols},
                            order, width, forward=True)
        return both.select(*[
            F.coalesce(f"_b_{c}", f"_f_{c}").alias(c) if c in cols else F.col(c) for c in df.columns
        ])
    if strategy == "interpolate":
        return interpolate(df, cols, by, ts, order, width)
    raise ValueError(f"unknown strategy {strategy!r}")


def interpolate(df, cols, by, ts, order=(), width=None) -> DataFrame:
    """Linear by row position; trailing gaps repeat the last value, leading gaps stay."""
    from hangarflow.operators.ordered import row_index

    at = row_index(df, by, ts, "_pos", order, width)
    spots = {c: F.struct(F.col("_pos").alias("p"), F.col(c).alias("v")) for c in cols}
    back = nearest_seen(at, by, ts, {f"_b_{c}": (s, F.col(c).isNotNull()) for c, s in spots.items()}, order, width)
    both = nearest_seen(back, by, ts, {f"_f_{c}": (s, F.col(c).isNotNull()) for c, s in spots.items()},
                        order, width, forward=True)

    def blend(c: str) -> Column:
        b, f = F.col(f"_b_{c}"), F.col(f"_f_{c}")
        part = (F.col("_pos") - b.p) / (f.p - b.p)
        return F.coalesce(
            F.col(c),
            F.when(f.isNotNull() & b.isNotNull(), b.v + (f.v - b.v) * part).when(f.isNull(), b.v),
        )

    return both.select(*[blend(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def bounds(df, cols, method: str, k: float, by=None) -> DataFrame:
    """Lower and upper limit per column (per category when ``by`` is given)."""
    groups = names(by) if by else []
    if method == "iqr":
        q = exact_quantiles(df, cols, [0.25, 0.75], groups)
        edges = {c: (F.col(c)[0], F.col(c)[1], (F.col(c)[1] - F.col(c)[0]) * k) for c in cols}
    elif method == "zscore":
        q = df.groupBy(*groups).agg(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c) for c in cols])
        edges = {c: (F.col(f"{c}.m"), F.col(f"{c}.m"), F.col(f"{c}.s") * k) for c in cols}
    else:
        raise ValueError(f"unknown method {method!r}")
    return q.select(*groups, *[
        F.struct((lo - reach).alias("lo"), (hi + reach).alias("hi")).alias(c) for c, (lo, hi, reach) in edges.items()
    ])


def outliers(df, cols, method="iqr", k=None, action="cap", measured: DataFrame | None = None) -> DataFrame:
    """Cap (default), flag or remove values outside the limits (taken from ``measured`` if given).

    The limits arrive as a scalar subquery: no driver round trip, no cross join.
    """
    k = k if k is not None else (rules.IQR_FACTOR if method == "iqr" else 3.0)
    cols = [c for c in cols if c in df.columns]
    limit = bounds(df if measured is None else measured, cols, method, k).select(F.struct(*cols).alias("b")).scalar()
    known = df.withColumn("_b", limit)

    def outside(c):
        return F.coalesce(~F.col(c).between(F.col(f"_b.{c}.lo"), F.col(f"_b.{c}.hi")), F.lit(False))

    if action == "cap":
        return known.select(*[
            scalars.clip(F.col(c), F.col(f"_b.{c}.lo"), F.col(f"_b.{c}.hi")).alias(c) if c in cols else F.col(c)
            for c in df.columns
        ])
    if action == "flag":
        return known.select(*df.columns, *[outside(c).alias(f"{c}_is_outlier") for c in cols])
    if action == "remove":
        keep = ~outside(cols[0])
        for c in cols[1:]:
            keep = keep & ~outside(c)
        return known.where(keep).select(*df.columns)
    raise ValueError(f"unknown action {action!r}")


def outlier_score(df, value: str, by, k=rules.IQR_FACTOR, domain=None, kind="sensor_type") -> DataFrame:
    """Flag plus score (distance beyond the quartiles in IQRs) per group, and domain ranges."""
    by = names(by)
    q = exact_quantiles(df, [value], [0.25, 0.75], by).withColumnRenamed(value, "_q")
    joined = df.join(q, by, "left")
    iqr = F.col("_q")[1] - F.col("_q")[0]
    beyond = F.greatest(F.col("_q")[0] - F.col(value), F.col(value) - F.col("_q")[1], F.lit(0.0))
    in_domain = F.lit(True)
    for name, (lo, hi) in (domain or {}).items():
        in_domain = F.when(F.col(kind) == name, F.col(value).between(lo, hi)).otherwise(in_domain)
    dist = F.when(F.col(value).isNotNull(), F.coalesce(scalars.divide(beyond, iqr), F.when(beyond > 0, F.lit(999.0)).otherwise(0.0)))
    return joined.select(*df.columns, dist.alias("outlier_score"),
                         F.coalesce((dist > k) | ~in_domain, F.lit(False)).alias("is_outlier"))


def keep_first(df, keys, order: Sequence[str]) -> DataFrame:
    """First row per key in a total order.

    ``min_by`` combines map-side: a key whose copies fill a third of the table
    sends one row per task through the shuffle, where ``row_number`` would sort
    the whole group in one task.
    """
    keys = names(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    first = F.min_by(F.struct(*rest), F.struct(*order))
    kept = df.groupBy(*keys).agg(first.alias("_row"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def keep_last(df, keys, order: Sequence[str]) -> DataFrame:
    """Last row per key in a total order, combined map-side like :func:`keep_first`."""
    keys = names(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def collapse_copies(df: DataFrame, out: str = "_copies") -> DataFrame:
    """Exact copies become one row with a count; the counting combines map-side."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(out))


def expand_copies(df: DataFrame, count: str = "_copies", pieces: int = 1024) -> DataFrame:
    """The rows of :func:`collapse_copies` again.

    A row with very many copies is first cut into pieces that are shuffled apart,
    so no task writes them all.
    """
    rest = [c for c in df.columns if c != count]
    n = F.col(count)
    few = df.where(n <= pieces)
    many = df.where(n > pieces).withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    many = many.withColumn(count, F.floor(n / pieces) + (F.col("_i") < n % pieces).cast("long"))
    many = many.repartition(*rest, "_i").drop("_i")
    again = F.explode(F.sequence(F.lit(1).cast("long"), n))
    return few.unionByName(many).select(*rest, again.alias("_again")).drop("_again")


def impute_context(
    df, by="sensor_id", ts="measurement_timestamp", value="measurement_value", order=("id",),
    gap_minutes=rules.FILL_GAP_MINUTES, max_run=rules.FILL_MAX_RUN, median_hours=rules.MEDIAN_HOURS, width=HOUR,
) -> DataFrame:
    """Short gaps take the last value, longer ones a trailing median; both are marked.

    Short: last reading at most ``gap_minutes`` old and at most ``max_run`` empty
    readings since. Median: of the readings in [t - ``median_hours``, t), in work
    linear in the readings (:mod:`moving`); only the times in need ask for it.
    """
    from hangarflow.operators.ordered import running

    by = names(by)
    ok = F.col(value).isNotNull()
    counted = running(df, by, ts, {"_nulls": F.when(ok, 0).otherwise(1).cast("long")}, order, width)
    spot = F.struct(F.col(value).alias("v"), F.col(ts).alias("t"), F.col("_nulls").alias("k"))
    seen = nearest_seen(counted, by, ts, {"_last": (spot, ok)}, order, width)
    gap = F.unix_micros(ts) - F.unix_micros("_last.t")
    short = ~ok & (gap <= gap_minutes * 60_000_000) & (F.col("_nulls") - F.col("_last.k") <= max_run)
    # Read twice below: by the medians and by the answer.
    marked = staged(seen.withColumn("_short", F.coalesce(short, F.lit(False))))
    medians = trailing_median(marked, marked.where(~ok & ~F.col("_short")), by, ts, value, median_hours, "_median")
    filled = marked.join(medians, [*by, ts], "left")
    method = (
        F.when(ok, F.lit(None).cast("string")).when(F.col("_short"), "forward_fill")
        .when(F.col("_median").isNotNull(), "median")
    )
    new = F.when(ok, F.col(value)).when(F.col("_short"), F.col("_last.v")).otherwise(F.col("_median"))
    return filled.select(
        *[new.alias(c) if c == value else F.col(c) for c in df.columns],
        method.isNotNull().alias("is_imputed"), method.alias("imputation_method"),
    )


def silver_readings(readings: DataFrame, unit: str = "measurement_unit", width=HOUR) -> DataFrame:
    """Standardise ids and units, fill, flag outliers and score each reading.

    Score: 1.0 as measured, 0.7 when imputed, halved when an outlier, 0.0 without a value.
    """
    value, new_unit = scalars.convert_units(F.col("measurement_value"), F.col(unit), F.col("sensor_type"))
    std = readings.select(
        "id", "aircraft_id", scalars.normalise_id(F.col("sensor_id")).alias("sensor_id"), "sensor_type",
        "measurement_timestamp", value.alias("measurement_value"), new_unit.alias("measurement_unit"),
    )
    # The quartiles below read this several times; filling it again each time would cost more.
    filled = staged(impute_context(std, width=width))
    flagged = outlier_score(filled, "measurement_value", "sensor_type", domain=rules.READING_RANGES)
    score = (
        F.when(F.col("measurement_value").isNull(), 0.0)
        .otherwise(F.when(F.col("is_imputed"), 0.7).otherwise(1.0) * F.when(F.col("is_outlier"), 0.5).otherwise(1.0))
    )
    return flagged.withColumn("quality_score", score).withColumnRenamed("id", "source_record_id")


def silver_maintenance(events: DataFrame, taxonomy: DataFrame | None = None, parts: str | None = None) -> DataFrame:
    """Duration, downtime, severity, part count and component type of each event."""
    from hangarflow.operators.joins import with_default

    duration = scalars.hours_between(F.col("actual_start_date"), F.col("actual_end_date"))
    downtime = F.when(F.col("maintenance_type").isin("corrective", "unscheduled"), F.col("duration_hours")).otherwise(0.0)
    out = events.withColumn("duration_hours", duration).withColumn("downtime_hours", downtime)
    out = out.withColumn("failure_severity", scalars.severity(F.col("downtime_hours")))
    if parts:
        listed = scalars.parts_array(F.col(parts))
        out = out.withColumn("parts_replaced_count", F.coalesce(F.when(listed.isNotNull(), F.size(listed)), F.lit(0)))
    if taxonomy is not None:
        key = [c for c in taxonomy.columns if c != "component_type"]
        out = with_default(out, taxonomy, key, "component_type", "unknown")
    return out


def silver_inventory(snapshots: DataFrame) -> DataFrame:
    """Status, value and criticality; criticality follows status and lead time."""
    status = scalars.stock_status(F.col("quantity_available"), F.col("reorder_point"))
    return snapshots.select(
        "*", status.alias("stock_status"), (F.col("quantity_on_hand") * F.col("unit_cost")).alias("total_value"),
    ).withColumn(
        "criticality_level",
        F.when((F.col("stock_status") == "out_of_stock") & (F.col("lead_time_days") >= 14), "high")
        .when(F.col("stock_status").isin("out_of_stock", "low_stock"), "medium").otherwise("low"),
    )
