"""Pooling of binned signals and dense feature matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.tiling import skeleton


def mean_pool(signal: DataFrame, sizes: DataFrame, factor: int, keys: tuple[str, ...] = ("chrom", "track")) -> DataFrame:
    """Mean of each ``factor`` bins of a dense signal (keys, bin, value); the last, partial tile is dropped.

    sizes (keys[0], n_bins) has the number of bins.  A factor of 1 or less changes nothing.  Absent bins count as 0.
    """
    if factor <= 1:
        return signal.select(*keys, "bin", "value")
    n = sizes.select(keys[0], "n_bins")
    rows = signal.join(n, keys[0]).where(F.col("bin") < F.col("n_bins") - F.col("n_bins") % factor)
    return rows.groupBy(*keys, F.floor(F.col("bin") / factor).alias("bin")).agg((F.sum("value") / factor).alias("value"))


def align_bins(signal: DataFrame, sizes: DataFrame, source: int, target: int, keys: tuple[str, ...] = ("chrom", "track")) -> DataFrame:
    """A signal of resolution source at resolution target; sizes: chrom, chrom_size.  Bins that no full tile fills are absent (0)."""
    if target < source:
        raise ValueError("signals can't be refined")
    bins = sizes.select("chrom", F.ceil(F.col("chrom_size") / source).alias("n_bins"))
    return mean_pool(signal, bins, target // source, keys)


def roll_up(signal: DataFrame, factors: tuple[int, ...], keys: tuple[str, ...] = ("chrom", "track")) -> DataFrame:
    """Sums and counts at several resolutions from one pass: keys, factor, bin, total, n_bins, value (mean of full tiles only)."""
    each = signal.withColumn("factor", F.explode(F.array(*map(F.lit, factors))))
    out = each.groupBy(*keys, "factor", F.floor(F.col("bin") / F.col("factor")).alias("bin")).agg(F.sum("value").alias("total"), F.count("*").alias("n_bins"))
    return out.where("n_bins = factor").withColumn("value", F.col("total") / F.col("n_bins"))


def merge_tracks(signal: DataFrame, how: str = "mean", keys: tuple[str, ...] = ("chrom", "name", "bin")) -> DataFrame:
    """One value a bin for tracks of one name.  signal: keys, track_idx, value.

    mean: over all tracks.  pairwise: the running mean ((a + b) / 2 + c) / 2 ... in the order of track_idx.
    """
    if how == "mean":
        return signal.groupBy(*keys).agg(F.avg("value").alias("value"))
    if how != "pairwise":
        raise ValueError(how)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("track_idx", "value"))), lambda s: s["value"])
    lists = signal.groupBy(*keys).agg(ordered.alias("v"))
    step = F.aggregate(F.slice("v", 2, F.greatest(F.size("v") - 1, F.lit(0))), F.element_at("v", 1).cast("double"), lambda acc, v: (acc + v) / 2)
    return lists.select(*keys, step.alias("value"))


def feature_matrix(features: DataFrame, sizes: DataFrame, resolution: int, columns: list[str]) -> DataFrame:
    """Every bin with a column for each named feature, 0 where it has none (NaN stays): chrom, start, end, then ``columns``.

    features: chrom, bin, name, value, with one value for each.  The names are given, so that the pivot needs no extra pass.
    """
    wide = features.groupBy("chrom", "bin").pivot("name", columns).agg(F.max("value"))
    return skeleton(sizes, resolution).join(wide, ["chrom", "bin"], "left").select("chrom", "start", "end", *(F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(c) for c in columns))
