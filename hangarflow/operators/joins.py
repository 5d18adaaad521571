"""As-of, interval, point-in-time and lookup joins as shuffles and windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from hangarflow.operators.ordered import DAY, names, nearest_seen


def asof(
    left: DataFrame, right: DataFrame, by, left_ts: str, right_ts: str, columns: Sequence[str],
    forward: bool = False, width: int | None = DAY, ties: Sequence[str] = (),
) -> DataFrame:
    """Nearest right row at or before (after, if ``forward``) each left row.

    Both sides are tagged and stacked, so one shuffle by (entity, time bucket)
    replaces a range join; equal times count as a match. ``ties`` orders right
    rows of the same time. Unmatched left rows get nulls.
    """
    by = names(by)
    payload = F.struct(*[F.col(c) for c in columns])
    # Right rows sort before left rows of the same time when looking back, after when looking ahead.
    side = F.lit(1 if forward else 0)
    events = right.select(
        *by, F.col(right_ts).alias("_t"), side.alias("_side"), F.lit(False).alias("_keep"),
        payload.alias("_event"), F.struct(*(list(ties) or [right_ts])).alias("_tie"),
    )
    rows = left.withColumn("_row", F.struct(*left.columns)).select(
        *by, F.col(left_ts).alias("_t"), (F.lit(1) - side).alias("_side"), F.lit(True).alias("_keep"), "_row",
    )
    both = rows.unionByName(events, allowMissingColumns=True)
    found = nearest_seen(
        both, by, "_t", {"_hit": (F.col("_event"), F.col("_event").isNotNull())},
        order=["_side", "_tie"], width=width, forward=forward,
    )
    return found.where("_keep").select("_row.*", *[F.col(f"_hit.{c}").alias(c) for c in columns])


def forward_within(left, events, by, ts: str, event_ts: str, days: int, out: str = "label", width=DAY) -> DataFrame:
    """1 when an event lies in [t, t + days], both ends included."""
    hit = asof(left, events, by, ts, event_ts, [event_ts], forward=True, width=width)
    gap = F.unix_micros(event_ts) - F.unix_micros(ts)
    return hit.select(*left.columns, F.col(event_ts).alias("next_event"),
                      F.coalesce((gap <= days * DAY * 1_000_000).cast("int"), F.lit(0)).alias(out))


def trailing_counts(
    snapshots: DataFrame, events: DataFrame, by, day: str, event_day: str, counts: dict[str, int],
) -> DataFrame:
    """Events in the last N days (today included) for each entity-day row.

    Events are counted per day, stacked with the snapshots and summed over a day
    frame: one shuffle, and an entity's window holds calendar days only.
    """
    by = names(by)
    per_day = events.groupBy(*by, F.col(event_day).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    rows = snapshots.withColumn("_row", F.struct(*snapshots.columns)).select(
        *by, F.col(day).alias("_d"), F.lit(0).cast("long").alias("_n"), "_row")
    w = Window.partitionBy(*by).orderBy(F.unix_date("_d").cast("long"))
    stacked = rows.unionByName(per_day, allowMissingColumns=True)
    return stacked.select("_row", *[
        F.sum("_n").over(w.rangeBetween(-n, 0)).alias(out) for out, n in counts.items()
    ]).where(F.col("_row").isNotNull()).select("_row.*", *counts)


def with_default(df: DataFrame, lookup: DataFrame, on, column: str, default: str) -> DataFrame:
    """Left lookup with a fallback value; the lookup is broadcast only if measured small."""
    joined = df.join(lookup, names(on), "left")
    return joined.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def orphans(child: DataFrame, parent: DataFrame, child_key, parent_key) -> DataFrame:
    ck, pk = names(child_key), names(parent_key)
    cond = [child[c] == parent[p] for c, p in zip(ck, pk)]
    return child.join(parent, cond, "left_anti")


def point_in_time(facts: DataFrame, versions: DataFrame, by, ts: str, columns: Sequence[str],
                  start: str = "effective_start_date", end: str = "effective_end_date", width=None) -> DataFrame:
    """The version valid at each fact; versions of an entity do not overlap.

    Looks back to the last started version and checks its end, instead of an
    inequality join that would pair every fact with every version of its entity.
    """
    hit = asof(facts, versions, by, ts, start, [start, end, *columns], width=width, ties=[start, end])
    return hit.where(F.col(ts) < F.col(end)).select(*facts.columns, *columns)
