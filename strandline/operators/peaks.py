"""Peak calling on binned signals: local maxima, distance, prominence, width, boundaries and area."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators import block_peaks, blocks, medians
from strandline.storage import written

#: Fixed values of the caller.
PROMINENCE_FRACTION = 0.5
MIN_PROMINENCE = 1e-4
MIN_WIDTH_BINS = 2
MIN_DISTANCE_BP = 200
REL_HEIGHT = 0.5
#: Bins of one block of a track.
BLOCK = 1 << 16

PEAKS = "start long, end long, summit long, auc double, signal_value double, prominence double"


def local_maxima(signal: DataFrame, keys: tuple[str, ...] = ("chrom", "track"), block: int = BLOCK) -> DataFrame:
    """Bins where a signal (keys, bin, value) rises, stays, and falls: keys, bin (the middle of the flat run), value.

    Runs of equal values are collapsed first; the runs at either end never count.  A track is taken in blocks of bins, each in a window of
    its own; only the outermost runs of the blocks (two a block) are then put together along the whole track.
    """
    rows = signal.select(*keys, "bin", "value", F.floor(F.col("bin") / block).alias("block"))
    w = Window.partitionBy(*keys, "block").orderBy("bin")
    rows = rows.withColumn("new", F.coalesce((F.col("value") != F.lag("value").over(w)).cast("int"), F.lit(1)))
    rows = rows.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = rows.groupBy(*keys, "block", "run").agg(F.min("bin").alias("a"), F.max("bin").alias("b"), F.first("value").alias("value"))
    w = Window.partitionBy(*keys, "block").orderBy("run")
    runs = runs.withColumn("left", F.lag("value").over(w)).withColumn("right", F.lead("value").over(w))
    whole = [*keys, "a", "b", "value", "left", "right"]
    inner = runs.where("left IS NOT NULL AND right IS NOT NULL").select(*whole)
    w = Window.partitionBy(*keys).orderBy("a")
    goes_on = (F.col("value") == F.lag("value").over(w)) & (F.col("a") == F.lag("b").over(w) + 1)
    outer = runs.where("left IS NULL OR right IS NULL").withColumn("new", F.when(goes_on, 0).otherwise(1))
    outer = outer.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*keys, "run").agg(
        F.min("a").alias("a"), F.max("b").alias("b"), F.first("value").alias("value"), F.min_by("left", "a").alias("own_left"), F.max_by("right", "a").alias("own_right")
    )
    w = Window.partitionBy(*keys).orderBy("run")
    outer = outer.withColumn("left", F.coalesce("own_left", F.lag("value").over(w))).withColumn("right", F.coalesce("own_right", F.lead("value").over(w))).select(*whole)
    peaks = inner.unionByName(outer).where("left < value AND right < value")
    return peaks.select(*keys, F.floor((F.col("a") + F.col("b")) / 2).alias("bin"), "value")


def _maxima(x: np.ndarray) -> np.ndarray:
    """Middles of the flat runs that both neighbours lie below."""
    if len(x) < 3:
        return np.empty(0, np.int64)
    heads = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    tails = np.append(heads[1:], len(x)) - 1
    v = x[heads]
    inner = np.flatnonzero((v[1:-1] > v[:-2]) & (v[1:-1] > v[2:])) + 1
    return (heads[inner] + tails[inner]) // 2


def _spread(x: np.ndarray, peaks: np.ndarray, distance: int) -> np.ndarray:
    """Peaks left when, from the highest down, each removes those nearer than distance."""
    if distance <= 1:
        return peaks
    keep = np.ones(len(peaks), bool)
    for k in np.argsort(x[peaks], kind="stable")[::-1].tolist():
        if keep[k]:
            a, b = np.searchsorted(peaks, peaks[k] - distance, "right"), np.searchsorted(peaks, peaks[k] + distance, "left")
            keep[a:k] = False
            keep[k + 1 : b] = False
    return peaks[keep]


def _base(values: list[float], lows: list[float]) -> list[float]:
    """For each of the tops from left to right, the minimum between it and the nearest strictly higher one on its left, by a stack;
    lows: the minimum between each top and the one before it."""
    out, stack = [], []  # stack: (value, minimum since the entry below it)
    for v, low in zip(values, lows):
        while stack and stack[-1][0] <= v:
            low = min(low, stack.pop()[1])
        stack.append((v, low))
        out.append(low)
    return out


def _prominences(x: np.ndarray, peaks: np.ndarray) -> np.ndarray:
    """Height above the higher of both bases.  Between neighbouring tops (all local maxima and both ends) the signal falls, then rises,
    so only tops and the lowest bins between them are looked at one by one."""
    if not len(peaks):
        return np.empty(0)
    tops = np.unique(np.concatenate(([0], _maxima(x), [len(x) - 1])))
    valleys = np.minimum.reduceat(x, tops[:-1])  # from each top to before the next
    values = x[tops]
    left = np.array(_base(values.tolist(), [values[0], *np.minimum(valleys, values[1:]).tolist()]))
    right = np.array(_base(values[::-1].tolist(), [values[-1], *np.minimum(valleys, values[1:])[::-1].tolist()]))[::-1]
    at = np.searchsorted(tops, peaks)
    return x[peaks] - np.maximum(left[at], right[at])


def _walk(x: np.ndarray, start: np.ndarray, height: np.ndarray, step: int) -> np.ndarray:
    """From each start the nearest bin in a direction that isn't above its height, or the last one; all starts take a step at once."""
    at, go = start.copy(), np.arange(len(start))
    while len(go):
        go = go[(x[at[go]] > height[go]) & (at[go] > 0 if step < 0 else at[go] < len(x) - 1)]
        at[go] += step
    return at


def _crossings(x: np.ndarray, peaks: np.ndarray, prominences: np.ndarray, rel_height: float) -> tuple[np.ndarray, np.ndarray]:
    """Where the signal crosses prominence * rel_height below each peak, left and right, by straight lines between bins."""
    height = x[peaks] - prominences * rel_height
    out = []
    for step in (-1, 1):
        at = _walk(x, peaks, height, step)
        inner = np.clip(at - step, 0, len(x) - 1)
        below = x[at] < height
        rise = np.where(below, x[inner] - x[at], 1.0)
        out.append(at - step * np.where(below, (height - x[at]) / rise, 0.0))
    return out[0], out[1]


def find_peaks(x: np.ndarray, resolution: int, distance_bp: int = MIN_DISTANCE_BP, least: float | None = None) -> dict[str, np.ndarray]:
    """Peaks of one dense signal, in base pairs from its first bin; least: the lowest prominence, else by the signal's median."""
    x = np.asarray(x, np.float64)
    none = {k: np.empty(0) for k in ("start", "end", "summit", "auc", "signal_value", "prominence")}
    if not len(x) or not (x > 0).any():
        return none
    if least is None:
        least = max(PROMINENCE_FRACTION * float(np.median(x[x > 0])), MIN_PROMINENCE)
    peaks = _spread(x, _maxima(x), max(1, math.ceil(distance_bp / resolution)))
    prominences = _prominences(x, peaks)
    peaks, prominences = peaks[prominences >= least], prominences[prominences >= least]
    left, right = _crossings(x, peaks, prominences, REL_HEIGHT)
    wide = right - left >= MIN_WIDTH_BINS
    if not wide.any():
        return none
    peaks, prominences, left, right = peaks[wide], prominences[wide], left[wide], right[wide]
    a = np.floor(left).astype(np.int64)
    b = np.clip(np.ceil(right).astype(np.int64), a + 1, len(x))
    area = np.array([(x[i:j].sum() - (x[i] + x[j - 1]) / 2) * resolution for i, j in zip(a, b)])
    return {"start": a * resolution, "end": b * resolution, "summit": peaks * resolution, "auc": area, "signal_value": x[peaks], "prominence": prominences}


def call_peaks(signal: DataFrame, resolution: int, distance_bp: int = MIN_DISTANCE_BP, keys: tuple[str, ...] = ("chrom", "track"), block: int = BLOCK, fan: int = block_peaks.FAN) -> DataFrame:
    """Peaks of every dense signal: keys, then PEAKS.

    signal: rows (keys, bin, value), or blocks (keys, block_idx, values) of ``block`` bins; it is written once as blocks.  Suppression by distance, prominence and width look
    along a whole track, but no task holds more than a block: see operators.block_peaks.
    """
    dense = signal.select(*keys, "block_idx", F.col("values").cast("array<double>").alias("values")) if "values" in signal.columns else blocks.from_rows(signal, keys, block)
    dense = written(dense, "blocks")
    least = nonzero_median(dense.select(*keys, F.explode("values").alias("value")), keys)
    return block_peaks.call_peaks(dense, resolution, distance_bp, least, block, keys, REL_HEIGHT, MIN_WIDTH_BINS, fan)


def nonzero_median(signal: DataFrame, keys: tuple[str, ...] = ("chrom", "track")) -> DataFrame:
    """Median of the positive values of each track (null without any), and the least prominence that follows from it."""
    positive = medians.exact_median(signal.where(F.col("value") > 0), keys, "value", "median_nonzero")
    m = medians.null_safe(signal.select(*keys).distinct(), positive, keys, "left")
    return m.withColumn("min_prominence", F.greatest(F.coalesce(F.col("median_nonzero") * PROMINENCE_FRACTION, F.lit(0.0)), F.lit(MIN_PROMINENCE)))
