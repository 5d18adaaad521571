"""Splits, folds, scaling, feature choice and class balance."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F, types as T

from hangarflow import rules
from hangarflow.functions.scalars import divide
from hangarflow.operators.ordered import row_index
from hangarflow.operators.profile import correlations
from hangarflow.operators.quantiles import exact_quantiles
from hangarflow.session import staged


def training_set(df: DataFrame, use_engineered: bool = True, target: str = "will_fail_7days"):
    """(rows without nulls, feature names, target)."""
    features = [c for c in df.columns if c not in rules.NOT_FEATURES] if use_engineered else rules.BASIC_FEATURES
    return df.dropna(subset=[*features, target]), features, target


def _dates(df, ts) -> DataFrame:
    """One row per date with counts and running position; bounded by the calendar, so ``ts`` has to be a date."""
    if not isinstance(df.schema[ts].dataType, T.DateType):
        raise TypeError(f"{ts} is not a date")
    per = df.groupBy(ts).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(ts)
    return per.select(
        ts, "_n", (F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"),
        (F.row_number().over(w) - 1).alias("_idx"), F.sum("_n").over(Window.partitionBy()).alias("_total"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("_dates"))


def time_split(df: DataFrame, ts: str = "date", ratios=rules.SPLIT, gap: int = rules.SPLIT_GAP, mode: str = "days",
               tie: str = "aircraft_id", width: int | None = None) -> DataFrame:
    """Add ``split`` = train / validation / test / gap, in time order.

    ``days`` leaves out ``gap`` calendar days after each cut. ``rows`` leaves out
    ``gap`` rows, ordered by (date, ``tie``). Rows never get a global number:
    whole dates are placed from per-date counts, and only the few dates that hold
    a cut are ranked, in chunks of ``width`` ids.
    """
    if abs(sum(ratios) - 1.0) >= 0.01:
        raise ValueError("ratios must sum to 1")
    dates = _dates(df, ts)
    train_end = F.floor(F.col("_total") * F.lit(ratios[0]))
    val_end = F.floor(F.col("_total") * F.lit(ratios[0] + ratios[1]))
    if mode == "days":
        cut = dates.agg(
            F.struct(F.max(F.when(F.col("_before") <= train_end, F.col(ts))).alias("a"),
                     F.max(F.when(F.col("_before") <= val_end, F.col(ts))).alias("b")).alias("c")).scalar()
        d = F.col(ts)
        label = (
            F.when(d < F.col("_c.a"), "train")
            .when((d >= F.date_add("_c.a", gap)) & (d < F.col("_c.b")), "validation")
            .when(d >= F.date_add("_c.b", gap), "test").otherwise("gap"))
        return df.withColumn("_c", cut).select(*df.columns, label.alias("split"))
    if mode != "rows":
        raise ValueError(f"unknown gap mode {mode!r}")

    def place(pos):
        return (
            F.when(pos < train_end, "train").when(pos < train_end + gap, F.when(pos < val_end, "gap").otherwise(
                F.when(pos < val_end + gap, "gap").otherwise("test")))
            .when(pos < val_end, "validation").when(pos < val_end + gap, "gap").otherwise("test"))

    first, last = place(F.col("_before")), place(F.col("_before") + F.col("_n") - 1)
    edges = [train_end, train_end + gap, val_end, val_end + gap]
    mixed = first != last
    for e in edges:  # a short segment may begin and end inside one date
        mixed = mixed | ((e > F.col("_before")) & (e < F.col("_before") + F.col("_n")))
    dates = dates.withColumn("_mixed", mixed).withColumn("_whole", first)
    tagged = df.join(dates, ts)
    whole = tagged.where(~F.col("_mixed")).select(*df.columns, F.col("_whole").alias("split"))
    ranked = row_index(tagged.where("_mixed"), ts, tie, "_rank", width=width, start=0)
    return whole.unionByName(ranked.select(*df.columns, place(F.col("_before") + F.col("_rank")).alias("split")))


def ts_folds(df: DataFrame, ts: str = "date", folds: int = rules.CV_FOLDS, gap: int = 0) -> DataFrame:
    """Expanding folds over distinct dates: a row enters each fold as train or test, but not as train in the ``gap`` dates before the test part."""
    size = F.floor(F.col("_dates") / (folds + 1))
    roles = []
    for i in range(1, folds + 1):
        start = F.col("_dates") - size * (folds - i + 1)
        role = F.when(F.col("_idx") < start - gap, "train").when(F.col("_idx") < start, F.lit(None)).when(F.col("_idx") < start + size, "test")
        roles.append(F.when(role.isNotNull(), F.struct(F.lit(i).alias("fold"), role.alias("role"))))
    picked = F.explode(F.filter(F.array(*roles), lambda r: r.isNotNull()))
    return df.join(_dates(df, ts), ts).select(*df.columns, picked.alias("_f")).select(*df.columns, "_f.fold", "_f.role")


def hash_parts(df: DataFrame, key: Sequence[str], shares: Sequence[float], strata: str | None = None, seed: int = 42, out: str = "part") -> DataFrame:
    """Add the number of the part a row falls into, the parts' shares exact in rows for each value of ``strata`` (null is one too).

    A part ends at the floor of its cumulated share. Rows are ordered by a hash of ``key``, but never sorted as a whole:
    they are counted in 2**10 ranges of the hash, a range that lies inside one part goes there as it is, and only rows of ranges
    with a cut are ranked. Rows of equal keys are told apart by nothing else, so ``key`` should be unique.
    """
    groups = ["_stratum"] if strata else []
    hashed = df.withColumn("_h", F.xxhash64(*key, F.lit(seed))).withColumn("_b", F.shiftright("_h", 54))
    if strata:
        hashed = hashed.withColumn("_stratum", F.xxhash64(strata, F.col(strata).isNull()))
    per = hashed.groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy(*groups)
    per = per.withColumn("_before", F.sum("_n").over(own.orderBy("_b")) - F.col("_n")).withColumn("_all", F.sum("_n").over(own))
    # A little is added before rounding down: 0.7 + 0.15 is meant to be 0.85.
    cuts = F.array(*[F.floor(F.col("_all") * sum(shares[:i]) + 1e-9) for i in range(1, len(shares))]) if len(shares) > 1 else F.array().cast("array<bigint>")
    place = lambda pos: F.size(F.filter("_cuts", lambda c: c <= pos))
    per = per.withColumn("_cuts", cuts).withColumn("_first", place(F.col("_before"))).withColumn("_cut", F.col("_first") != place(F.col("_before") + F.col("_n") - 1))
    # At most 2**10 rows for each stratum, counted once: few enough strata to be broadcast, so that only rows of a range with a cut are shuffled.
    known = hashed.join(F.broadcast(staged(per)), [*groups, "_b"])
    whole = known.where(~F.col("_cut")).select(*df.columns, F.col("_first").alias(out))
    rank = F.row_number().over(Window.partitionBy(*groups, "_b").orderBy("_h", *key)) - 1
    edge = known.where("_cut").withColumn("_r", rank)
    return whole.unionByName(edge.select(*df.columns, place(F.col("_before") + F.col("_r")).alias(out)))


def random_split(df: DataFrame, key: Sequence[str], ratios=rules.SPLIT, strata: str | None = None, seed: int = 42) -> DataFrame:
    """Add ``split`` = train / validation / test by row hash; with ``strata`` the shares hold for each of its values (stratified)."""
    names = F.array(*map(F.lit, ("train", "validation", "test")))
    return hash_parts(df, key, ratios, strata, seed, "_part").select(*df.columns, F.get(names, F.col("_part")).alias("split"))


def k_folds(df: DataFrame, key: Sequence[str], folds: int = rules.CV_FOLDS, strata: str | None = None, seed: int = 42) -> DataFrame:
    """Each row enters every fold, once as test and else as train; with ``strata`` each fold tests the same share of every value."""
    parts = hash_parts(df, key, [1 / folds] * folds, strata, seed, "_part")
    roles = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("fold"), F.when(F.col("_part") == i, "test").otherwise("train").alias("role")) for i in range(folds)]))
    return parts.select(*df.columns, roles.alias("_f")).select(*df.columns, "_f.fold", "_f.role")


def split(df: DataFrame, method: str = "time_based", key: Sequence[str] = ("aircraft_id", "date"), label: str | None = None, **how) -> DataFrame:
    """``time_based`` (default), ``random`` or ``stratified`` by ``label``."""
    if method == "time_based":
        return time_split(df, **how)
    if method == "random":
        return random_split(df, key, **how)
    if method == "stratified":
        return random_split(df, key, strata=label, **how)
    raise ValueError(f"unknown split method {method!r}")


def cross_validation(df: DataFrame, method: str = "time_series_split", key: Sequence[str] = ("aircraft_id", "date"), label: str | None = None, **how) -> DataFrame:
    """``time_series_split`` (default), ``k_fold`` or ``stratified_k_fold`` by ``label``."""
    if method == "time_series_split":
        return ts_folds(df, **how)
    if method == "k_fold":
        return k_folds(df, key, **how)
    if method == "stratified_k_fold":
        return k_folds(df, key, strata=label, **how)
    raise ValueError(f"unknown cross-validation method {method!r}")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows / (classes x rows of the class)."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("records"))
    total = per.agg(F.struct(F.sum("records").alias("n"), F.count(F.lit(1)).alias("k")).alias("t")).scalar()
    return per.withColumn("_t", total).select(
        label, "records", divide(F.col("_t.n"), F.col("_t.k") * F.col("records")).alias("weight"),
        divide(F.col("_t.n") - F.col("records"), F.col("records")).alias("imbalance_ratio"))


def weighted(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Attach the balanced weight of each row's class. The weights, a row for each class, are counted once and broadcast: the rows aren't shuffled at each pass over them."""
    w = staged(class_weights(df, label).select(label, F.col("weight").alias(out)))
    return df.join(F.broadcast(w), label)


def scale(train: DataFrame, other: DataFrame, cols: Sequence[str], method: str = "standard") -> DataFrame:
    """Scale ``other`` with statistics of ``train`` only. Standard uses the population deviation."""
    if method == "standard":
        stats = {c: F.struct(F.avg(c).alias("a"), F.stddev_pop(c).alias("b")) for c in cols}
        fitted = train.agg(F.struct(*[v.alias(c) for c, v in stats.items()]).alias("s"))
    elif method == "minmax":
        stats = {c: F.struct(F.min(c).alias("a"), (F.max(c) - F.min(c)).alias("b")) for c in cols}
        fitted = train.agg(F.struct(*[v.alias(c) for c, v in stats.items()]).alias("s"))
    elif method == "robust":
        q = exact_quantiles(train, cols, [0.25, 0.5, 0.75])
        fitted = q.select(F.struct(*[
            F.struct(F.col(c)[1].alias("a"), (F.col(c)[2] - F.col(c)[0]).alias("b")).alias(c) for c in cols]).alias("s"))
    else:
        raise ValueError(f"unknown method {method!r}")
    known = other.withColumn("_s", fitted.scalar())

    def scaled(c):
        spread = F.when(F.col(f"_s.{c}.b") == 0, F.lit(1.0)).otherwise(F.col(f"_s.{c}.b"))
        return ((F.col(c) - F.col(f"_s.{c}.a")) / spread).alias(c)

    return known.select(*[scaled(c) if c in cols else F.col(c) for c in other.columns])


def feature_report(df: DataFrame, cols: Sequence[str], target: str, variance=rules.VARIANCE_MIN,
                   correlation=rules.CORRELATION_MAX, top=rules.FEATURES_MAX) -> DataFrame:
    """Why each column is kept or dropped: low variance, too close to an earlier kept column, or beyond the top N.

    Variances and pair correlations come from one pass each; the greedy choice
    works on that matrix, whose size is the number of columns, not of rows.
    """
    spark = df.sparkSession
    var = df.agg(*[F.var_samp(c).alias(c) for c in cols]).first().asDict()
    alive = [c for c in cols if (var[c] or 0.0) > variance]
    near: dict[str, set[str]] = {c: set() for c in alive}
    if len(alive) > 1:
        close = correlations(df, alive).where(F.abs("correlation") > correlation)
        for r in close.collect():
            near[r.left_column].add(r.right_column)
            near[r.right_column].add(r.left_column)
    kept: list[str] = []
    for c in alive:
        if not near[c] & set(kept):
            kept.append(c)
    strength = df.agg(*[F.abs(F.corr(c, target)).alias(c) for c in kept]).first().asDict() if kept else {}
    best = sorted(kept, key=lambda c: (-(strength[c] or 0.0), c))[:top]
    reason = {c: "low_variance" for c in cols if c not in alive}
    reason |= {c: "correlated" for c in alive if c not in kept} | {c: "not_in_top" for c in kept if c not in best}
    return spark.createDataFrame(
        [(c, float(var[c]) if var[c] is not None else None, c in best, reason.get(c, "kept")) for c in cols],
        "column_name string, variance double, selected boolean, reason string")


def select_features(df, cols, target, **limits) -> list[str]:
    return [r.column_name for r in feature_report(df, cols, target, **limits).where("selected").collect()]


def _uniform(*cols):
    """A stable number in [0, 1) per row: the same after any recompute."""
    return F.pmod(F.xxhash64(*cols), F.lit(1_000_000_007)) / F.lit(1_000_000_007.0)


def smallest_hash(df: DataFrame, n: int, key: Sequence[str], seed: int) -> DataFrame:
    """Exactly ``n`` of the rows (or all there are), those with the smallest hash of ``key``: the same after any recompute.

    Rows are counted in 2**16 ranges of the hash; the ranges below the cut come whole, only the rows of the
    one range that holds it are ranked.
    """
    hashed = df.withColumn("_h", F.xxhash64(*key, F.lit(seed))).withColumn("_b", F.shiftright("_h", 48))
    per = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("_b"))  # at most 2**16 rows
    cut = per.withColumn("upto", upto).where(F.col("upto") >= n).agg(F.min(F.struct("_b", (F.col("upto") - F.col("n")).alias("before"))).alias("c")).scalar()
    known = hashed.withColumn("_c", cut)
    below = known.where(F.col("_c").isNull() | (F.col("_b") < F.col("_c._b")))
    order = Window.partitionBy("_b").orderBy("_h", *key)
    edge = known.where(F.col("_b") == F.col("_c._b")).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n - F.col("_c.before"))
    return below.select(*df.columns).unionByName(edge.select(*df.columns))


def numbered(df: DataFrame, key: Sequence[str], seed: int, out: str) -> DataFrame:
    """Add a number from 0 to rows - 1, in the order of a hash of ``key``, without a sort of all rows: places in 2**16 ranges of the hash, after the rows of those before."""
    hashed = df.withColumn("_h", F.xxhash64(*key, F.lit(seed))).withColumn("_b", F.shiftright("_h", 48))
    per = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = per.select("_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_before"))  # at most 2**16 rows
    place = F.row_number().over(Window.partitionBy("_b").orderBy("_h", *key)) - 1
    return hashed.withColumn("_r", place).join(before, "_b").select(*df.columns, (F.col("_before") + F.col("_r")).alias(out))


def permuted(x, n, seed: int, rounds: int = 24):
    """The number that a keyed permutation of 0 .. n - 1 puts at place ``x``: swap-or-not rounds, a bijection for any ``n``.

    In each round a place and its mirror image about a keyed number change places if a bit hashed from the greater of them says so.
    """
    def swap(at, r):
        other = F.pmod(F.pmod(F.xxhash64(F.lit(seed), r), n) + n - at, n)
        return F.when(F.xxhash64(F.lit(seed), r, F.greatest(at, other)) > 0, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x.cast("long"), swap)


def repeated(df: DataFrame, n: int, have: int, key: Sequence[str], seed: int, out: str) -> DataFrame:
    """Exactly ``n`` copies of the ``have`` rows, numbered per row in ``out``: as even as possible, odd ones to the smallest hashes."""
    each, extra = divmod(n, have)
    more = smallest_hash(df, extra, key, seed).withColumn(out, F.lit(each + 1)) if extra else None
    even = df.withColumn(out, F.explode(F.sequence(F.lit(1), F.lit(each)))) if each else None
    return even if more is None else more if even is None else even.unionByName(more)


def resample(df: DataFrame, label: str, key: Sequence[str], method: str, ratio: float = 0.5, seed: int = 42) -> DataFrame:
    """Random under- or over-sampling to minority / majority = ``ratio`` (rounded to whole rows), by row hash."""
    y = F.coalesce(F.col(label) == 1, F.lit(False))
    n = df.agg(F.count_if(y).alias("p"), F.count_if(~y).alias("q")).first()
    is_small = y if n["p"] <= n["q"] else ~y
    small, large = sorted((n["p"], n["q"]))
    few, many = df.where(is_small), df.where(~is_small)
    if method == "under":
        return few.unionByName(smallest_hash(many, min(large, round(small / ratio)), key, seed))
    if method == "over":
        want = max(small, round(large * ratio))
        return many.unionByName(repeated(few, want, small, key, seed, "_copy").select(*df.columns)) if small else df
    raise ValueError(f"unknown method {method!r}")


#: Points to a leaf of the search tree, and levels at most: the tree goes to the executors as one literal.
LEAF, LEVELS = 128, 12


def _squared(a, b, dims: int):
    """Squared distance of two arrays, spelled out so that it compiles."""
    return functools.reduce(lambda s, d: s + d, [(a[j] - b[j]) * (a[j] - b[j]) for j in range(dims)], F.lit(0.0))


def _numbers(values, kind: str):
    """An array as one constant: a call for each element would take minutes."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def _bound(value, body):
    """``body`` of the constant, which so stands in the plan once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _cuts(sample: np.ndarray, levels: int) -> tuple[list[int], list[float]]:
    """(axis, cut) of each inner node of a complete k-d tree, the root at 1: halves of the sample along the widest axis."""
    axis, cut, parts = [0] * (1 << levels), [math.inf] * (1 << levels), {1: sample}
    for node in range(1, 1 << levels):
        own = parts.pop(node)
        if len(own) > 1 and (wide := np.ptp(own, axis=0)).max() > 0:
            axis[node] = int(wide.argmax())
            v = own[:, axis[node]]
            middle = np.sort(v)[(len(v) - 1) // 2]
            cut[node] = float(middle if middle < v.max() else v[v < middle].max())
        left = own[:, axis[node]] <= cut[node]
        parts[2 * node], parts[2 * node + 1] = own[left], own[~left]
    return axis, cut


def neighbours(points: DataFrame, k: int, leaf: int = LEAF, levels: int = LEVELS) -> DataFrame:
    """The nearest neighbours of distinct points (id, x array): (id, rank, n_id, n_x, d), ``k`` for each if there are so many; exact.

    A k-d tree over all axes, cut at the medians of a sample, deals the points to leaves of about ``leaf``; it gets
    deeper as the points grow. The k-th distance among the points of its own leaf bounds a point's search: it meets the points of
    each leaf whose box (of the real points) is not farther than that, and no other point can be among its
    nearest. Equal distances go to the lesser id. A null or NaN coordinate counts as 0 here, an infinite one as 1e150.

    Beyond ``2**levels`` leaves the leaves grow, and the bound comes from part of a leaf. How many pairs are compared
    depends on the data; in many independent dimensions it nears all of them. Only those within the bound are kept.
    """
    facts = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("dims")).first()
    dims = facts["dims"] or 0
    levels = max(0, min(levels, math.ceil(math.log2(max(1, facts["n"] / leaf)))))
    first, parts = 1 << levels, math.ceil(max(1, facts["n"]) / leaf / (1 << levels))
    plain = F.transform("x", lambda v: F.greatest(F.least(F.coalesce(F.nanvl(v, F.lit(0.0)), F.lit(0.0)), F.lit(1e150)), F.lit(-1e150)))
    known = points.select("id", "x", plain.alias("g"))
    share = min(1.0, 32 * first / max(1, facts["n"]))
    sample = [r["g"] for r in known.where(_uniform("id", F.lit("sample")) < share).select("g").collect()] if levels else []
    axis, cut = _cuts(np.array(sample, float).reshape(-1, max(1, dims)), levels)
    place = _bound(F.struct(_numbers(axis, "int").alias("axis"), _numbers(cut, "double").alias("cut")), lambda t: F.aggregate(
        F.array(*map(F.lit, range(levels))).cast("array<int>"), F.lit(1), lambda node, _: node * 2 + (F.col("g")[t["axis"][node]] > t["cut"][node]).cast("int")))
    placed = staged(known.withColumn("leaf", place if levels else F.lit(1)).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts))))

    low, high = np.full((2 * first, dims), math.inf), np.full((2 * first, dims), -math.inf)
    edges = placed.groupBy("leaf").agg(*(f(F.col("g")[j]).alias(f"{n}{j}") for j in range(dims) for n, f in (("a", F.min), ("b", F.max))))
    for r in edges.collect():
        low[r["leaf"]], high[r["leaf"]] = [r[f"a{j}"] for j in range(dims)], [r[f"b{j}"] for j in range(dims)]
    for node in range(first - 1, 0, -1):
        low[node], high[node] = np.minimum(*low[2 * node:2 * node + 2]), np.maximum(*high[2 * node:2 * node + 2])

    # The bound: the k-th distance in the point's own leaf, or none if that has too few points.
    cells = placed.groupBy("leaf", "part").agg(F.collect_list(F.struct("id", "g")).alias("cell"))
    others = F.filter("cell", lambda z: z["id"] != F.col("id"))
    ranked = F.array_sort(F.transform(others, lambda z: _squared(F.col("g"), z["g"], dims)))
    bounded = placed.join(cells, ["leaf", "part"]).select("id", "g", F.coalesce(F.get(ranked, F.lit(k - 1)), F.lit(math.inf)).alias("most"))

    def gap(t, node):
        far = [F.greatest(t["low"][node * dims + j] - F.col("g")[j], F.col("g")[j] - t["high"][node * dims + j], F.lit(0.0)) for j in range(dims)]
        return functools.reduce(lambda s, d: s + d * d, far, F.lit(0.0))

    boxes = F.struct(_numbers(low.ravel().tolist(), "double").alias("low"), _numbers(high.ravel().tolist(), "double").alias("high"))
    near = _bound(boxes, lambda t: F.aggregate(
        F.array(*map(F.lit, range(levels))).cast("array<int>"), F.array(F.lit(1)),
        lambda nodes, _: F.filter(F.flatten(F.transform(nodes, lambda m: F.array(m * 2, m * 2 + 1))), lambda m: gap(t, m) <= F.col("most"))))
    visits = staged(bounded).select("id", "g", "most", F.explode(near if levels else F.array(F.lit(1))).alias("leaf"))
    there = placed.select("leaf", F.col("id").alias("n_id"), F.col("g").alias("n_g"), F.col("x").alias("n_x"))
    apart = _squared(F.col("g"), F.col("n_g"), dims)
    met = visits.join(there, (visits["leaf"] == there["leaf"]) & (F.col("id") != F.col("n_id")) & (apart <= F.col("most"))).select("id", "n_id", F.sqrt(apart).alias("d"))
    order = Window.partitionBy("id").orderBy("d", "n_id")
    best = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(there.select("n_id", "n_x"), "n_id").select("id", "rank", "n_id", "n_x", "d")


def smote(df: DataFrame, features: Sequence[str], label: str, key: Sequence[str], ratio: float = 1.0,
          k: int = rules.SMOTE_NEIGHBOURS, seed: int = 42) -> DataFrame:
    """Add synthetic minority rows between a row and one of its k nearest minority rows, to exactly ``ratio`` of the majority.

    Equal feature vectors are one point, so copies do not pair up with each other; a class with fewer than two
    distinct vectors is left as it is. Which neighbour and how far is decided by row hash, hence the same
    on recompute. Output: features, label and ``is_synthetic``.
    """
    y = F.coalesce(F.col(label) == 1, F.lit(False))
    n = df.agg(F.count_if(y).alias("p"), F.count_if(~y).alias("q")).first()
    minority = 1 if n["p"] <= n["q"] else 0
    have, other = (n["p"], n["q"]) if minority == 1 else (n["q"], n["p"])
    want = max(0, round(other * ratio) - have)
    original = df.select(*features, label, F.lit(False).alias("is_synthetic"))
    if have < 2 or want == 0:
        return original
    vector = F.array(*[F.col(c).cast("double") for c in features])
    rows = df.where(F.col(label) == minority).select(F.xxhash64(*key).alias("row"), vector.alias("x"))
    # Distinct vectors get an id from their content.
    rows = staged(rows.select("row", "x", F.xxhash64("x").alias("id")))
    points = staged(rows.groupBy("id").agg(F.first("x").alias("x")))
    if len(points.take(2)) < 2:
        return original
    found = neighbours(points, k).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("rank", "n_x"))).alias("near"))
    made = repeated(rows, want, have, ["row"], seed, "copy").join(found, "id")
    pick = F.element_at("near", (F.floor(_uniform("row", "copy", F.lit(seed + 1)) * F.size("near")) + 1).cast("int"))["n_x"]
    step = _uniform("row", "copy", F.lit(seed + 2))
    blended = made.select(F.zip_with("x", pick, lambda a, b: a + (b - a) * step).alias("x"))
    synthetic = blended.select(*[F.col("x")[i].alias(c) for i, c in enumerate(features)],
                               F.lit(minority).alias(label), F.lit(True).alias("is_synthetic"))
    return original.unionByName(synthetic)
