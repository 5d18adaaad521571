"""Quality scores, rule checks and schema checks: one pass per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from hangarflow import rules
from hangarflow.functions.scalars import divide
from hangarflow.operators import windows
from hangarflow.operators.ordered import names


def _total(parts: Sequence[Column]) -> Column:
    return reduce(add, parts)


def completeness_expr(cols: Sequence[str]) -> Column:
    nulls = _total([F.count_if(F.col(c).isNull()) for c in cols])
    return 1 - divide(nulls, F.count(F.lit(1)) * len(cols))


def validity_expr(ranges: Mapping[str, tuple[float, float]], columns: Sequence[str]) -> Column:
    used = {c: r for c, r in ranges.items() if c in columns}
    if not used:
        return F.lit(1.0)
    good = _total([F.count_if(F.col(c).between(*r)) for c, r in used.items()])
    seen = _total([F.count(c) for c in used])
    return F.coalesce(divide(good, seen), F.lit(1.0))


def completeness(df: DataFrame) -> DataFrame:
    """1 - empty cells / all cells; null for an empty table."""
    return df.agg(completeness_expr(df.columns).alias("completeness"))


def validity(df, ranges=None) -> DataFrame:
    return df.agg(validity_expr(ranges or rules.VALID_RANGES, df.columns).alias("validity"))


def consistency(df, by, ts, value, width=None, order=()) -> DataFrame:
    """Share of entities whose value never falls; single-row entities are not judged."""
    per = windows.monotone(df, by, ts, value, width, order).where("steps > 0")
    return per.agg(
        F.coalesce(F.avg((F.col("decreases") == 0).cast("double")), F.lit(1.0)).alias("consistency"),
        F.count(F.lit(1)).alias("entities_checked"),
        F.sum("decreases").alias("decreases"),
    )


def timeliness_expr(ts: str, as_of: str) -> Column:
    return F.greatest(F.lit(0.0), 1 - F.datediff(F.lit(as_of).cast("date"), F.max(F.to_date(ts))) / 365)


def timeliness(df, ts, as_of: str) -> DataFrame:
    return df.agg(timeliness_expr(ts, as_of).alias("timeliness"))


def score(scores: DataFrame, dimensions=None, gate=rules.QUALITY_GATE) -> DataFrame:
    """Mean of the scores present in a one-row frame, with the gate verdict."""
    dims = [F.col(c) for c in (dimensions or scores.columns)]
    present = F.filter(F.array(*dims), lambda s: s.isNotNull())
    mean = divide(F.aggregate(present, F.lit(0.0), lambda a, s: a + s), F.size(present))
    overall = F.coalesce(mean, F.lit(0.0))
    return scores.select("*", overall.alias("overall_score"), (overall >= gate).alias("passed"))


def report(df, ranges, ts=None, as_of=None, dimensions=("completeness", "validity")) -> DataFrame:
    """Scores, record and column counts and nulls per column as (metric, value) rows."""
    known = {
        "completeness": lambda: completeness_expr(df.columns),
        "validity": lambda: validity_expr(ranges, df.columns),
        "timeliness": lambda: timeliness_expr(ts, as_of),
    }
    one = df.agg(
        *[known[d]().alias(d) for d in dimensions],
        F.count(F.lit(1)).cast("double").alias("record_count"),
        F.lit(float(len(df.columns))).alias("column_count"),
        *[F.count_if(F.col(c).isNull()).cast("double").alias(f"missing_{c}") for c in df.columns],
    )
    scored = score(one, list(dimensions)).drop("passed")
    return scored.unpivot([], scored.columns, "metric", "value")


def null_profile(df) -> DataFrame:
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = one.unpivot(["_n"], df.columns, "column_name", "missing_count")
    return long.select("column_name", "missing_count",
                       (100 * divide(F.col("missing_count"), F.col("_n"))).alias("missing_pct"))


def duplicates(df, keys) -> DataFrame:
    """Rows beyond the first of each key, and their share.

    Copies collapse map-side, so a key with a third of the rows costs one row per task.
    """
    per_key = df.groupBy(*names(keys)).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_records"),
        F.coalesce(divide(F.sum(F.col("_n") - 1), F.sum("_n")), F.lit(0.0)).alias("duplicate_rate"),
    )


def low_variance(df, cols, limit=rules.NEAR_CONSTANT_STD) -> DataFrame:
    one = df.agg(*[F.stddev_samp(c).alias(c) for c in cols])
    return one.unpivot([], list(cols), "column_name", "std").select(
        "column_name", "std", (F.col("std") < limit).alias("near_constant"))


def schema_drift(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Added, removed and retyped columns, with how many rows each column fills."""
    actual = dict(df.dtypes)
    allcols = sorted(set(actual) | set(expected))
    one = df.agg(*[(F.count(c) if c in actual else F.lit(0).cast("long")).alias(c) for c in allcols])
    long = one.unpivot([], allcols, "column_name", "filled_rows")

    def pick(mapping):
        return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[F.col("column_name")]

    seen, want = pick(actual), pick(expected)
    change = (
        F.when(want.isNull(), "added").when(seen.isNull(), "removed")
        .when(seen != want, "retyped").otherwise("same")
    )
    return long.select("column_name", want.alias("expected_type"), seen.alias("actual_type"),
                       change.alias("change"), "filled_rows")


def require_columns(df: DataFrame, required: Sequence[str], strict: bool = False) -> list[str]:
    """Missing columns; raises in strict mode. Looks at the schema only."""
    missing = [c for c in required if c not in df.columns]
    if missing and strict:
        raise ValueError(f"missing required columns: {missing}")
    return missing


def conform(df: DataFrame, types: Mapping[str, str], parsers: Mapping[str, Column] | None = None) -> DataFrame:
    """Cast to declared types; cells that do not fit become null and are listed in ``_errors``."""
    parsers = parsers or {}
    cast = {c: parsers.get(c, F.col(c).try_cast(t)) for c, t in types.items() if c in df.columns}
    errors = F.filter(
        F.array(*[F.when(F.col(c).isNotNull() & v.isNull(), F.lit(c)) for c, v in cast.items()]),
        lambda e: e.isNotNull(),
    )
    # Errors look at the raw cells, so they are taken in the same projection as the casts.
    return df.select(*[cast.get(c, F.col(c)).alias(c) for c in df.columns], errors.alias("_errors"))


def apply_policy(conformed: DataFrame, policy: str = "log_and_continue", max_rate: float = rules.ERROR_RATE_PIPELINE):
    """(good rows, bad rows, rate gate). ``fail_fast`` raises inside the job on the first bad row."""
    bad = F.size("_errors") > 0
    if policy == "fail_fast":
        # In a filter, so that pruning the error column cannot drop the check.
        stop = F.raise_error(F.concat(F.lit("bad cells: "), F.concat_ws(",", "_errors"))).cast("boolean")
        checked = conformed.where(F.when(bad, stop).otherwise(F.lit(True)))
        return checked.drop("_errors"), conformed.limit(0), error_rate(conformed, max_rate)
    if policy == "log_and_continue":
        return conformed.drop("_errors"), conformed.where(bad), error_rate(conformed, max_rate)
    if policy == "quarantine":
        return conformed.where(~bad).drop("_errors"), conformed.where(bad), error_rate(conformed, max_rate)
    raise ValueError(f"unknown error policy {policy!r}")


def error_rate(conformed: DataFrame, max_rate: float) -> DataFrame:
    rate = divide(F.count_if(F.size("_errors") > 0), F.count(F.lit(1)))
    return conformed.agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.size("_errors") > 0).alias("errors"),
        F.coalesce(rate, F.lit(0.0)).alias("error_rate"),
        (F.coalesce(rate, F.lit(0.0)) <= max_rate).alias("within_limit"),
    )


# ------------------------------------------------------------------ rule rows

def rule(name: str, kind: str, issue: Column, threshold: float, severity: str, scope: Column | None = None) -> dict:
    """A row rule: rows in ``scope`` fail it when ``issue`` is true."""
    return {"name": name, "kind": kind, "issue": issue, "threshold": threshold,
            "severity": severity, "scope": F.lit(True) if scope is None else scope}


def check_rules(df: DataFrame, table: str, checks: Sequence[dict], check_time: str) -> DataFrame:
    """All row rules in one aggregate; one output row per rule."""
    one = df.agg(*[
        F.struct(
            F.count_if(r["scope"]).alias("total"), F.count_if(r["scope"] & r["issue"]).alias("issues"),
        ).alias(r["name"]) for r in checks
    ])
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(r["name"]).alias("check_name"), F.lit(r["kind"]).alias("check_type"),
            F.col(f"{r['name']}.total").alias("total_records"), F.col(f"{r['name']}.issues").alias("records_with_issues"),
            F.lit(float(r["threshold"])).alias("threshold_value"), F.lit(r["severity"]).alias("severity"),
        ) for r in checks
    ]))
    flat = one.select(rows.alias("r")).select("r.*")
    quality = F.coalesce(1 - divide(F.col("records_with_issues"), F.col("total_records")), F.lit(1.0))
    return finish_rules(flat.withColumn("quality_score", quality), table, check_time)


def finish_rules(flat: DataFrame, table: str, check_time: str) -> DataFrame:
    ok = F.col("quality_score") >= F.col("threshold_value")
    return flat.select(
        F.lit(table).alias("table_name"), F.lit(check_time).cast("timestamp").alias("check_timestamp"),
        "check_name", "check_type", "total_records", "records_with_issues", "quality_score", "threshold_value",
        F.when(ok, "pass").when(F.col("severity") == "critical", "fail").otherwise("warning").alias("status"),
        (~ok & (F.col("severity") == "critical")).alias("alert_sent"),
    )
