"""Order statistics over a moving time frame, in work linear in the readings.

A frame of ``hours`` before each asked time would, as a join or a window of lists, meet every reading once for each
time that asks. Here time is cut into chunks as long as the frame: a reading goes to its own chunk and to the
next one, an asked time to its own, and that is all a time needs. Inside a chunk the values, in time order, make a wavelet
matrix: bit by bit of their ranks, the positions are split into those with a 0 and those with a 1, and a frame is a pair of
positions that follows the split down to the wanted rank. Each reading is placed once for each bit, whatever the number and the
overlap of the frames.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from hangarflow.operators.batched import entity_batches
from hangarflow.operators.ordered import HOUR, names


def kth_of_frames(values: np.ndarray, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
    """For each frame the k-th smallest (from 0) of values[low:high]; k must be inside."""
    known, ranks = np.unique(values, return_inverse=True)
    low, high, k = low.copy(), high.copy(), k.copy()
    found = np.zeros(len(k), np.int64)
    for bit in reversed(range(max(1, len(known) - 1).bit_length())):
        ones = (ranks >> bit) & 1 == 1
        zeros_before = np.concatenate([[0], np.cumsum(~ones)])
        first, last = zeros_before[low], zeros_before[high]
        up = k >= last - first
        k = np.where(up, k - (last - first), k)
        low, high = np.where(up, zeros_before[-1] + low - first, first), np.where(up, zeros_before[-1] + high - last, last)
        found = found * 2 + up
        ranks = np.concatenate([ranks[~ones], ranks[ones]])
    return known[found]


def medians_of_frames(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The median of values[low:high] of each frame, the mean of the middle two of an even number; NaN for an empty frame."""
    out = np.full(len(low), np.nan)
    some = np.flatnonzero(high > low)
    if len(some):
        low, high = low[some], high[some]
        many = high - low
        a, b = (kth_of_frames(values, low, high, k) for k in ((many - 1) // 2, many // 2))
        out[some] = a + (b - a) * 0.5
    return out


def trailing_median(readings: DataFrame, asks: DataFrame, by: str | Sequence[str], ts: str, value: str, hours: int, out: str = "median") -> DataFrame:
    """(by, ts, out) for the distinct times of ``asks``: the median of the values in [ts - ``hours``, ts); times without one are left out.

    A task holds the readings of one entity in two frame lengths, or a batch of such chunks, which are solved together. Null keys never meet, as in a join; NaN counts as the greatest value.
    """
    by = names(by)
    span = hours * HOUR * 1_000_000
    at = F.unix_micros(F.col(ts))
    asked = asks.select(*by, at.alias("_t")).distinct().withColumn("_chunk", F.floor(F.col("_t") / F.lit(span)).cast("long"))
    chunks = asked.select(*by, "_chunk").distinct()
    own = F.floor(at / F.lit(span)).cast("long")
    seen = readings.where(F.col(value).isNotNull()).select(
        *by, at.alias("_t"), F.col(value).cast("double").alias("_v"), F.explode(F.array(own, own + 1)).alias("_chunk"))
    rows = seen.join(chunks, [*by, "_chunk"], "left_semi").select(*by, "_chunk", "_t", "_v").unionByName(
        asked.select(*by, "_chunk", "_t", F.lit(None).cast("double").alias("_v")).where(" AND ".join(f"`{c}` IS NOT NULL" for c in by)).withColumn("_ask", F.lit(True)),
        allowMissingColumns=True)

    fields = [*(asked.schema[c] for c in by), T.StructField("_t", T.LongType()), T.StructField(out, T.DoubleType())]
    names_out = [f.name for f in fields]

    def solve(table: pa.Table, new: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Many chunks at once, one after the other on a common scale: a frame never reaches beyond its own."""
        ask = table["_ask"].combine_chunks().is_valid().to_numpy(zero_copy_only=False)
        t, chunk = table["_t"].to_numpy(), table["_chunk"].to_numpy()
        place = (np.cumsum(new) - 1) * (4 * span) + (t - (chunk - 1) * span)
        seen_at, times = place[~ask], place[ask]
        low, high = np.searchsorted(seen_at, times - span, "left"), np.searchsorted(seen_at, times, "left")
        v = table["_v"].to_numpy()[~ask]
        some = high > low
        asked_rows = table.filter(pa.array(ask)).filter(pa.array(some))
        made = pa.Table.from_arrays([*(asked_rows[c] for c in by), asked_rows["_t"], pa.array(medians_of_frames(v, low, high)[some], pa.float64())], names=names_out)
        yield from made.to_batches()

    solved = entity_batches(rows, [*by, "_chunk"], "_t", solve, T.StructType(fields))
    zone = dict(asks.dtypes)[ts]
    return solved.select(*by, F.timestamp_micros("_t").cast(zone).alias(ts), out)
