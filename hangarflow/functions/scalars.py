"""Column expressions: ladders, conversions, parsing, JSON access."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from hangarflow import rules


def _ladder(x: Column, steps, default: str, strict: bool) -> Column:
    out = None
    for label, low in steps:
        hit = (x > low) if strict else (x >= low)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def stock_status(available: Column, reorder: Column) -> Column:
    """A null reorder point falls through to ``in_stock`` when stock is positive."""
    return (
        F.when(available <= 0, "out_of_stock")
        .when(available <= reorder, "low_stock")
        .when(available > reorder * 3, "overstock")
        .otherwise("in_stock")
    )


def risk_level(probability: Column) -> Column:
    """A null probability is ``low``."""
    return _ladder(probability, rules.RISK_LEVELS, rules.RISK_DEFAULT, strict=False)


def severity(downtime_hours: Column) -> Column:
    return _ladder(downtime_hours, rules.SEVERITY_HOURS, rules.SEVERITY_DEFAULT, strict=True)


def register_sql(spark: SparkSession) -> None:
    """The two warehouse functions for users of SQL text."""
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION calculate_stock_status(available INT, reorder INT)
        RETURNS STRING RETURN CASE WHEN available <= 0 THEN 'out_of_stock'
            WHEN available <= reorder THEN 'low_stock'
            WHEN available > reorder * 3 THEN 'overstock' ELSE 'in_stock' END""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION categorize_risk_level(p DOUBLE)
        RETURNS STRING RETURN CASE WHEN p >= 0.75D THEN 'critical' WHEN p >= 0.5D THEN 'high'
            WHEN p >= 0.25D THEN 'medium' ELSE 'low' END""")


def clip(x: Column, low: Column, high: Column) -> Column:
    """Null stays null (``greatest``/``least`` alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(low, F.least(high, x)))


def divide(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def to_celsius(value: Column, unit: Column) -> Column:
    return (
        F.when(unit == "fahrenheit", (value - 32) * 5 / 9)
        .when(unit == "kelvin", value - rules.KELVIN_ZERO)
        .otherwise(value)
    )


def to_bar(value: Column, unit: Column) -> Column:
    return (
        F.when(unit == "psi", value * rules.PSI_TO_BAR)
        .when(unit == "pascal", value / rules.PASCAL_PER_BAR)
        .otherwise(value)
    )


def convert_units(value: Column, unit: Column, sensor_type: Column) -> tuple[Column, Column]:
    """(value, unit) in the target unit of the sensor type; other types pass."""
    return (
        F.when(sensor_type == "temperature", to_celsius(value, unit))
        .when(sensor_type == "pressure", to_bar(value, unit))
        .otherwise(value),
        F.when(sensor_type == "temperature", F.lit("celsius"))
        .when(sensor_type == "pressure", F.lit("bar"))
        .otherwise(unit),
    )


def parse_time(text: Column, formats=None, zone: str = "UTC") -> Column:
    """First format that fits, as a UTC timestamp; null when none does."""
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in (formats or rules.TIMESTAMP_FORMATS)]
    return F.to_utc_timestamp(F.coalesce(*tries), zone)


def normalise_id(text: Column) -> Column:
    """Trim, upper-case, any run of separators becomes one dash."""
    return F.upper(F.regexp_replace(F.trim(text), r"[\s_./-]+", "-"))


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(3.6e9)


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def business_key(*parts: Column | str) -> Column:
    """Deterministic id; nulls keep their place, so (a, null) differs from (null, a)."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("\\N")) for c in cols]), 256)


def json_number(text: Column, path: str) -> Column:
    return F.get_json_object(text, path).try_cast("bigint")


def parts_array(text: Column) -> Column:
    return F.from_json(text, "array<struct<part:bigint,qty:double>>")


def alert_field(probability: Column, field: int) -> Column:
    """Field ``field`` of the highest alert rule the probability meets, else null."""
    out = None
    for rule in rules.ALERT_RULES:
        hit = probability >= rule[1]
        value = F.lit(rule[field])
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def storage_tier(age_days: Column) -> Column:
    out = None
    for tier, limit in rules.STORAGE_TIERS:
        out = F.when(age_days <= limit, tier) if out is None else out.when(age_days <= limit, tier)
    return out.otherwise(rules.STORAGE_DEFAULT)
