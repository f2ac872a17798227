"""Sliding windows over chromosomes and stitching of what was computed in them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, STRIDE = 1 << 20, 1 << 19


def window_count(size: Column, window: int = WINDOW, stride: int = STRIDE) -> Column:
    """1 for a chromosome of one window at most; else as many strides as reach the end."""
    return F.when(size <= window, 1).otherwise(F.ceil((size - window) / stride) + 1).cast("long")


def _check(window: int, stride: int) -> None:
    if window <= 0 or not 0 < stride <= window:
        raise ValueError("window and stride must be positive, the stride no more than the window")


def generate_windows(sizes: DataFrame, window: int = WINDOW, stride: int = STRIDE) -> DataFrame:
    """From (chrom, chrom_size): chrom, chrom_size, window_idx, n_windows, start, end.  The last window is cut at the end."""
    _check(window, stride)
    one = sizes.select("chrom", "chrom_size", window_count(F.col("chrom_size"), window, stride).alias("n_windows"))
    each = one.withColumn("window_idx", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_windows") - 1)))
    start = F.col("window_idx") * stride
    return each.select("chrom", "chrom_size", "window_idx", "n_windows", start.alias("start"), F.least(start + window, F.col("chrom_size")).alias("end"))


def model_windows(windows: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds model_start, model_end: a window that is shorter than ``window`` is widened about its middle, if that stays on the genome's left end;
    others as they are.  Positions of results always follow start and end."""
    wide = F.floor((F.col("start") + F.col("end")) / 2) - window // 2
    short = (F.col("end") - F.col("start") != window) & (wide >= 0)
    return windows.withColumn("model_start", F.when(short, wide).otherwise(F.col("start"))).withColumn("model_end", F.when(short, wide + window).otherwise(F.col("end")))


def coverage(values: DataFrame, windows: DataFrame, resolution: int, stride: int = STRIDE) -> DataFrame:
    """How many windows keep each bin: chrom, bin, n_windows; values as stitch takes them (one track is looked at a bin)."""
    each = values.select("chrom", "window_idx", "local_bin").distinct().withColumn("track", F.lit("")).withColumn("value", F.lit(1))
    return placed(each, windows, resolution, stride).groupBy("chrom", "bin").agg(F.sum("value").alias("n_windows"))


def assign_batches(windows: DataFrame, batch_size: int = 10) -> DataFrame:
    return windows.withColumn("batch", F.floor(F.col("window_idx") / batch_size))


def whole_batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One record batch for each batch of assign_batches, from sorted rows that Spark may have cut anywhere."""
    held: list[pa.RecordBatch] = []
    of = None

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]  # some windows

    for part in rows:
        keys = list(zip(part.column("chrom").to_pylist(), part.column("batch").to_pylist()))
        a = 0
        for b in range(1, len(keys) + 1):
            if b < len(keys) and keys[b] == keys[a]:
                continue
            if held and keys[a] != of:
                yield joined()
                held = []
            held.append(part.slice(a, b - a))
            of, a = keys[a], b
    if held:
        yield joined()


def keep_ranges(windows: DataFrame, stride: int = STRIDE, gapless: int | None = None) -> DataFrame:
    """Adds keep_start, keep_end: the part of each window that the stitched track takes.

    The first window keeps its first stride, the last its last stride, the others their middle stride; a lone window all.  With
    windows of two strides this leaves a gap before the second window's middle and one, or an overlap, before the last
    window's part.  gapless gives the window size and closes them: every window but the first begins at its middle part, and
    ends where the next begins.
    """
    start, end, n, i = (F.col(c) for c in ("start", "end", "n_windows", "window_idx"))
    if gapless:
        margin = (gapless - stride) // 2
        keep_start = F.when(i == 0, start).otherwise(start + margin)
        keep_end = F.when(i == n - 1, end).otherwise(start + stride + margin)
    else:
        middle = start + F.floor((end - start - stride) / 2)
        keep_start = F.when((n == 1) | (i == 0), start).when(i == n - 1, F.greatest(end - stride, start)).otherwise(middle)
        keep_end = F.when((n == 1) | (i == n - 1), end).when(i == 0, F.least(start + stride, end)).otherwise(middle + stride)
    return windows.withColumn("keep_start", keep_start.cast("long")).withColumn("keep_end", keep_end.cast("long"))


def skeleton(sizes: DataFrame, resolution: int) -> DataFrame:
    """Every bin of every chromosome: chrom, bin, start, end."""
    n = F.ceil(F.col("chrom_size") / resolution)
    bins = sizes.where("chrom_size > 0").select("chrom", "chrom_size", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("bin"))
    start = F.col("bin") * resolution
    return bins.select("chrom", "bin", start.alias("start"), F.least(start + resolution, F.col("chrom_size")).alias("end"))


def stitch(values: DataFrame, windows: DataFrame, resolution: int, stride: int = STRIDE, gapless: int | None = None) -> DataFrame:
    """Window-local values (chrom, window_idx, track, local_bin, value) on the genome: chrom, track, bin, value.

    The kept range of each window is aligned outwards to whole bins; where two windows keep a bin the later one counts.
    Bins that no window keeps are absent: join a skeleton to see them as 0.
    """
    rows = placed(values, windows, resolution, stride, gapless)
    return rows.groupBy("chrom", "track", "bin").agg(F.max_by("value", "window_idx").alias("value"))


def placed(values: DataFrame, windows: DataFrame, resolution: int, stride: int = STRIDE, gapless: int | None = None) -> DataFrame:
    """The window-local values that are kept, with their genome bin: a row for each window that keeps it.

    Windows come from a row a chromosome, so Spark takes them for few; they grow with the genome, so they are never broadcast.
    """
    kept = keep_ranges(windows, stride, gapless)
    low = F.floor((F.col("keep_start") - F.col("start")) / resolution)
    high = F.ceil((F.least("keep_end", "end") - F.col("start")) / resolution)
    ranges = kept.select("chrom", "window_idx", "chrom_size", "start", low.alias("low"), high.alias("high"))
    rows = values.join(ranges.hint("merge"), ["chrom", "window_idx"]).where("local_bin >= low AND local_bin < high")
    rows = rows.withColumn("bin", F.floor((F.col("start") + F.col("low") * resolution) / resolution) + F.col("local_bin") - F.col("low"))
    return rows.where(F.col("bin") < F.ceil(F.col("chrom_size") / resolution))
