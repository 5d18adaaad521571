"""Whole entities in Arrow batches, and the daily window columns made so: the same numbers as the window expressions of :mod:`windows`, for wide sets over many rows.

As window expressions every frame is read anew for each of its statistics, row by row. Here rows come sorted by entity and time, whole
entities at a time, and one step of all frames is one array operation: step k adds the k-th row of each frame, in the order
and by the formulas of Spark's aggregates (sums from the frame's first row on, central moments by Welford's update).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from hangarflow.operators.ordered import names, spread

BLOCK = 32768  # rows worked on at a time, if no entity has more


def _starts(table: pa.Table, by: Sequence[str]) -> np.ndarray:
    """Whether a row begins an entity; nulls (and NaNs) are equal to each other."""
    new = np.zeros(len(table), bool)
    new[:1] = True
    for c in by:
        own = table[c].combine_chunks()
        a, b = own[1:], own[:-1]
        other = pc.fill_null(pc.not_equal(a, b), True).to_numpy(zero_copy_only=False)
        same = pc.and_(pc.is_null(a, nan_is_null=True), pc.is_null(b, nan_is_null=True)).to_numpy(zero_copy_only=False)
        new[1:] |= other & ~same
    return new


def entity_batches(df: DataFrame, by: Sequence[str], ts: str, solve: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``solve(rows, begins)`` over whole entities, sorted by ``ts``: one entity at a time, or as many as make ``BLOCK`` rows; ``begins`` marks their first rows."""
    block = BLOCK

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        due = block
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) < due:
                continue
            table = pa.Table.from_batches(held)
            new = _starts(table, by)
            cut = int(np.flatnonzero(new)[-1])  # the last entity may go on
            if cut:
                yield from solve(table.slice(0, cut), new[:cut])
                held = table.slice(cut).to_batches()
            due = max(block, 2 * (len(table) - cut))  # a long entity isn't looked through at each batch
        if held:
            table = pa.Table.from_batches(held)
            yield from solve(table, _starts(table, by))

    return spread(df, by).sortWithinPartitions(*by, ts).mapInArrow(work, schema)


def _frames(v: np.ndarray, ok: np.ndarray | None, rows: np.ndarray, size: int, short: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """(count, mean, m2, least, greatest) of the frames of up to ``size`` rows that end at ``rows``; ``short``: their places in the entity if a frame may lack rows."""
    n, total, mean, m2 = (np.zeros(len(rows)) for _ in range(4))
    low, high = np.full(len(rows), np.nan), np.full(len(rows), np.nan)
    for back in range(size - 1, -1, -1):
        at = rows - back
        if short is None and ok is None:
            x, n = v[at], n + 1
            d = x - mean
            part = d / n
            m2 += d * (d - part)
            total, mean = total + x, mean + part
            low, high = (x, x) if back == size - 1 else (np.fmin(low, x), np.maximum(high, x))
            continue
        here = np.ones(len(rows), bool) if short is None else short >= back
        at = np.where(here, at, 0)
        if ok is not None:
            here = here & ok[at]
        x = v[at]
        first = here & (n == 0)
        n = n + here
        d = np.where(here, x - mean, 0.0)
        part = d / np.maximum(n, 1)
        m2 += d * (d - part)
        total, mean = total + np.where(here, x, 0.0), mean + part
        low = np.where(here, np.where(first, x, np.fmin(low, x)), low)
        high = np.where(here, np.where(first, x, np.maximum(high, x)), high)
    return n, total, m2, low, high


def _whole(v: np.ndarray, known: np.ndarray, heads: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """(count, mean, sample deviation) of each column (a row of ``v``) and entity, added up in the order of its rows: step k takes the k-th row of all entities that have one."""
    order = np.argsort(-size, kind="stable")
    first, rising = heads[order], np.sort(size)
    n, total, mean, m2 = (np.zeros((len(v), len(heads))) for _ in range(4))
    for k in range(rising[-1]):
        m = len(size) - np.searchsorted(rising, k, "right")
        at = first[:m] + k
        here, x = known[:, at], v[:, at]
        n[:, :m] += here
        d = np.where(here, x - mean[:, :m], 0.0)
        part = d / np.maximum(n[:, :m], 1)
        m2[:, :m] += d * (d - part)
        total[:, :m] += np.where(here, x, 0.0)
        mean[:, :m] += part
    back = np.argsort(order)
    return n[:, back], (total / np.maximum(n, 1))[:, back], np.sqrt(m2 / np.maximum(n - 1, 1))[:, back]


def _column(values: np.ndarray, known: np.ndarray | None = None) -> pa.Array:
    return pa.array(values, pa.float64()) if known is None or known.all() else pa.array(values, pa.float64(), mask=~known)


def _made(table: pa.Table, new: np.ndarray, cols: Sequence[str], sizes: Sequence[int], place: bool) -> list[pa.Array]:
    """Rolling, trend and anomaly columns of whole entities, in the order of :func:`added`."""
    every = np.arange(len(table))
    heads = np.flatnonzero(new)
    entity = np.cumsum(new) - 1
    pos = every - heads[entity]
    rolling, trend, anomaly, values, valid = [], [], [], [], []
    for c in cols:
        own = table[c].combine_chunks()
        ok = pc.is_valid(own).to_numpy(zero_copy_only=False) if own.null_count else None
        v = pc.fill_null(own, 0.0).to_numpy(zero_copy_only=False).astype(float)
        known = np.ones(len(v), bool) if ok is None else ok
        values.append(v)
        valid.append(known)
        before = np.where(pos > 0, every - 1, every)
        trend.append(_column(v - v[before], known & known[before] & (pos > 0)))
        for size in sizes:
            n, total, m2, low, high = (np.empty(len(v)) for _ in range(5))
            for rows, full in ((np.flatnonzero(pos >= size - 1), True), (np.flatnonzero(pos < size - 1), False)):
                if len(rows):
                    got = _frames(v, ok, rows, size, None if full else pos[rows])
                    for out, part in zip((n, total, m2, low, high), got):
                        out[rows] = part
            some = None if ok is None else n > 0
            rolling += [_column(total / np.maximum(n, 1), some), _column(np.sqrt(m2 / np.maximum(n - 1, 1)), n > 1), _column(low, some), _column(high, some)]
            first = every - np.minimum(pos, size - 1)
            trend.append(_column((v - v[first]) / (np.minimum(pos, size - 1) + 1.0), (n >= 2) & known & known[first]))
    n, mean, std = _whole(np.stack(values), np.stack(valid), heads, np.diff([*heads, len(table)])) if len(cols) else ((),) * 3
    for i in range(len(cols)):
        off = np.abs(np.where(valid[i], values[i] - mean[i][entity], 0.0))
        anomaly += [_column(off / (std[i][entity] + 1e-6), valid[i] & (n[i][entity] > 1)), _column(off, valid[i])]
    return rolling + trend + anomaly + ([pa.array(pos, pa.int32())] if place else [])


def added(cols: Sequence[str], sizes: Sequence[int]) -> list[str]:
    """Names of the double columns, as the window expressions call them."""
    made = [f"{c}_rolling_{stat}_{n}d" for c in cols for n in sizes for stat in ("mean", "std", "min", "max")]
    made += [name for c in cols for name in (f"{c}_diff_1d", *(f"{c}_slope_{n}d" for n in sizes))]
    return made + [name for c in cols for name in (f"{c}_zscore", f"{c}_dist_from_mean")]


def daily(df: DataFrame, cols: Sequence[str], sizes: Sequence[int], by="aircraft_id", ts="date", place: bool = False) -> DataFrame:
    """Add the columns of :func:`added`, with ``place`` also the row's number in its entity (``days_in_operation``).

    A task holds one entity's rows (its calendar days) at a time, or ``BLOCK`` of them.
    """
    by, cols, sizes = names(by), list(cols), list(sizes)
    wrong = [c for c in cols if not isinstance(df.schema[c].dataType, T.DoubleType)]
    if wrong:
        raise TypeError(f"not of type double: {', '.join(wrong)}")
    fields = [*df.schema.fields, *(T.StructField(c, T.DoubleType()) for c in added(cols, sizes))]
    if place:
        fields.append(T.StructField("days_in_operation", T.IntegerType()))
    outs = [f.name for f in fields]

    def solve(table: pa.Table, new: np.ndarray) -> Iterator[pa.RecordBatch]:
        with np.errstate(all="ignore"):
            made = pa.Table.from_arrays([*table.columns, *_made(table, new, cols, sizes, place)], names=outs)
        yield from made.to_batches(max_chunksize=BLOCK)

    return entity_batches(df, by, ts, solve, T.StructType(fields))
