import random

from pyspark.sql import functions as F

from hangarflow.operators.quantiles import exact_quantiles


def test_brackets_give_exact_values(spark):
    rng = random.Random(5)
    # A third of all rows share one value; the rest spread unevenly.
    rows = [(("a", "b")[i % 2], 7.0 if i % 3 == 0 else rng.expovariate(0.1), None if i % 11 == 0 else float(i % 500))
            for i in range(30000)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(6)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 1.0]
    want = {r.g: (r.x, r.y) for r in df.groupBy("g").agg(
        *[F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(c) for c in "xy"]).collect()}
    for accuracy in (50, 10000):
        got = {r.g: (r.x, r.y) for r in exact_quantiles(df, ["x", "y"], probs, ["g"], accuracy).collect()}
        for g in want:
            for a, b in zip(got[g], want[g]):
                assert [round(v, 9) for v in a] == [round(v, 9) for v in b]


def test_no_groups_and_empty_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None)], "x double, e double")
    row = exact_quantiles(df, ["x", "e"], [0.5, 0.75]).first()
    assert row.x == [2.0, 3.0]
    assert [v for v in (row.e or []) if v is not None] == []
