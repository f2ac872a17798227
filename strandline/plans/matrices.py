"""Programs on predicted tracks and contact windows: dense feature matrices and contact tokens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import naming as N
from strandline.operators import binning, contacts

#: Assays in the order in which their columns are made, and the one resolution that has contact totals.
ASSAYS = ("atac", "chip_histone", "chip_tf")
CONTACT_RESOLUTION = 2048


def column_names(names: DataFrame, assay: str) -> DataFrame:
    """Track descriptions (track_idx, name, transcription_factor) with ``column``, the feature that the track belongs to."""
    if assay == "atac":
        return names.withColumn("column", F.lit("atac"))
    if assay == "chip_histone":
        return names.withColumn("column", N.histone_column("name"))
    if assay == "chip_tf":
        return names.withColumn("column", N.factor_column("name", "transcription_factor"))
    raise ValueError(f"unknown assay {assay!r}")


def assay_columns(signal: DataFrame, names: DataFrame, assay: str) -> DataFrame:
    """One value a bin and feature from the tracks (chrom, track_idx, bin, value) of an assay: chrom, bin, name, value.

    Tracks of one feature are averaged; those of histone marks as a running mean of pairs in the order of the tracks.  A bin that a track
    lacks counts as 0; a feature that no track has at a bin has no row there; NaN stays.
    """
    return _merged(signal, _shares(names, assay))


def _shares(names: DataFrame, assay: str) -> DataFrame:
    """What each track counts in its feature (track_idx, name, share): the tracks of one alike, or, in a running mean of pairs, half of what the next counts, the first two alike."""
    named = column_names(names, assay).select("track_idx", F.col("column").alias("name"))
    by_name = Window.partitionBy("name")  # tracks of an assay: some hundreds
    n, i = F.count("*").over(by_name), F.row_number().over(by_name.orderBy("track_idx"))
    halves = F.pow(F.lit(0.5), F.when(i == 1, n - 1).otherwise(n - i + 1))
    return named.withColumn("share", halves if assay == "chip_histone" else 1 / n)


def _merged(signal: DataFrame, shares: DataFrame) -> DataFrame:
    return signal.join(shares, "track_idx").groupBy("chrom", "bin", "name").agg(F.sum(F.col("value") * F.col("share")).alias("value"))


def contact_totals(rows: DataFrame, windows: DataFrame, resolution: int = CONTACT_RESOLUTION, least: float = contacts.MIN_FREQUENCY) -> DataFrame:
    """Row sums of the contact windows as features: chrom, bin, name, value.  rows: as contact_row_totals."""
    totals = contacts.contact_row_totals(rows, windows, resolution, least)
    return totals.join(_contact_names(rows), ["chrom", "track"]).select("chrom", "bin", "name", F.col("total").alias("value"))


def _contact_names(rows: DataFrame) -> DataFrame:
    """Names of the totals (chrom, track, name): by how many tracks the chromosome has.  Of the rows only these two columns are read."""
    tracks = rows.select("chrom", "track").distinct()
    return tracks.select("chrom", "track", N.contact_column("track", F.count("*").over(Window.partitionBy("chrom"))).alias("name"))


def fixed_bin_tokens(
    assays: dict[str, tuple[DataFrame, DataFrame, int]], sizes: DataFrame, resolution: int, columns: list[str] | None = None, contact_windows: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Every bin of every chromosome with a column for each feature: chrom, start, end, then the features (float, 0 where absent).

    assays: for each its tracks (chrom, track_idx, bin, value), their descriptions and their resolution.  A later assay's column replaces an
    earlier one's of the same name.  contact_windows (rows, windows as contact_row_totals) add totals at CONTACT_RESOLUTION only.
    columns: the features, where known; else they are read from the descriptions, which are few.
    """
    if not assays:
        raise ValueError("no assay given")
    parts, owners, listed = [], [], []
    for assay in assays:
        column_names(assays[assay][1], assay)  # an error for an unknown one
    for order, assay in enumerate(a for a in ASSAYS if a in assays):
        signal, names, source = assays[assay]
        aligned = binning.align_bins(signal, sizes, source, resolution, ("chrom", "track_idx"))
        shares = _shares(names, assay)
        parts.append(_merged(aligned, shares).withColumn("order", F.lit(order)))
        owners.append(signal.select("chrom", "track_idx").distinct().join(shares, "track_idx").select("chrom", "name", F.lit(order).alias("order")))
        listed.append(shares.select("name", F.lit(order).alias("order")))
    if contact_windows and resolution == CONTACT_RESOLUTION:
        order = F.lit(len(ASSAYS)).alias("order")
        parts.append(contact_totals(*contact_windows, resolution).withColumn("order", order))
        owners.append(_contact_names(contact_windows[0]).select("chrom", "name", order))
        listed.append(owners[-1].select("name", "order"))
    owner = reduce(DataFrame.unionByName, owners).groupBy("chrom", "name").agg(F.max("order").alias("order"))  # a row a chromosome and feature
    features = reduce(DataFrame.unionByName, parts).join(owner, ["chrom", "name", "order"])
    if columns is None:  # a name a feature
        columns = [r["name"] for r in reduce(DataFrame.unionByName, listed).groupBy("name").agg(F.min("order").alias("order")).orderBy("order", "name").collect()]
    matrix = binning.feature_matrix(features, sizes, resolution, columns)
    return matrix.select("chrom", "start", "end", *(F.col(c).cast("float").alias(c) for c in columns))


def contact_window_tokens(rows: DataFrame, resolution: int, stride: int, least: float = contacts.MIN_FREQUENCY, files: DataFrame | None = None) -> DataFrame:
    """Contact tokens of window files: rows (chrom, start, end, track_name, row_idx, row) as read_contacts gives them.

    Windows are numbered by their starts; windows cut short, also in the middle, keep what lies in them.  files (chrom, start, end) are all windows, where some may
    have no tracks and so no rows: they are numbered with the others.
    """
    windows = contacts.window_numbers(rows if files is None else files)
    numbered = rows.join(windows.select("chrom", "start", "end", "window_idx"), ["chrom", "start", "end"])
    return contacts.contact_tokens(numbered.select("chrom", "window_idx", F.col("track_name").alias("track"), "row_idx", "row"), windows, resolution, stride, least)
