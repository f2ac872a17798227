"""The programs of the library: peaks, feature matrices, regulatory elements, experiments, predictions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import naming as N
from strandline.operators import blocks, classify, experiments, intervals, nearest, peaks, tiling

#: Columns of the token tables, in order.
PEAK_TOKENS = ["token_id", "chrom", "start", "end", "summit", "auc", "signal_value", "prominence", "track_name", "assay"]
EXPERIMENT_PEAKS = ["token_id", "chrom", "start", "end", "summit", "auc", "signal_value", "p_value", "q_value", "strand", "experiment_accession", "target", "biosample", "assay"]


#: Outputs that can be stitched, and those that a prediction asks for.
STITCHABLE = ("atac", "chip_histone", "chip_tf", "cage", "dnase", "rna_seq")
REQUESTED = ("atac", "chip_histone", "chip_tf")


def requested_outputs(contact_maps: bool = True) -> list[str]:
    return [*REQUESTED, *(["contact_maps"] if contact_maps else [])]


def stitchable(output: str) -> str:
    """The name of an output, if it is one along the genome; contact maps and unknown ones are an error."""
    if output not in STITCHABLE:
        raise ValueError(f"{output} can't be stitched")
    return output


def predict_tracks(
    sizes: DataFrame, predictor: Callable, schema: str, resolution: int, window: int = tiling.WINDOW, stride: int = tiling.STRIDE, batch: int = 10, done: DataFrame | None = None
) -> DataFrame:
    """Tile, predict, stitch.  predictor: a mapInArrow function from windows (with model_start and model_end, their extent for a model of fixed
    length) to (chrom, window_idx, track, local_bin, value).  It is called once in a task, so it can load its model before the first batch, and gets each batch of
    ``batch`` windows (the last of a chromosome: what is left) whole, as one record batch.  Chromosomes in done (chrom) are left out."""
    sizes = experiments.still_to_do(sizes, done, ["chrom"]) if done is not None else sizes
    windows = tiling.generate_windows(sizes, window, stride)
    batches = tiling.assign_batches(tiling.model_windows(windows, window), batch)
    dealt = batches.repartition("chrom", "batch").sortWithinPartitions("chrom", "batch", "window_idx")
    return tiling.stitch(dealt.mapInArrow(lambda rows: predictor(tiling.whole_batches(rows)), schema), windows, resolution, stride)


def peak_tokens(signal: DataFrame, names: DataFrame, sizes: DataFrame, assay: str, source: int, target: int, sigma: float = 3.0) -> DataFrame:
    """Pool to the target resolution, smooth, call peaks, name.  names: track, track_name; sizes: chrom, chrom_size.

    signal: blocks (chrom, track, block_idx, values) of blocks.BLOCK bins, or rows (chrom, track, bin, value), which are brought into blocks first.  From there on no bin is a row.
    """
    factor = max(1, target // source)
    block = blocks.BLOCK // factor * factor
    if "values" not in signal.columns:
        signal = blocks.from_rows(signal, ("chrom", "track"), block, sizes.select("chrom", F.ceil(F.col("chrom_size") / source).alias("n_bins")))
    elif block != blocks.BLOCK:
        raise ValueError("blocks must hold whole tiles")
    smooth = blocks.smooth(blocks.pool(signal, factor, block), sigma, block // factor)
    found = peaks.call_peaks(smooth, max(source, target), block=block // factor)
    out = found.join(names, "track").withColumn("assay", F.lit(assay))
    out = out.withColumn("token_id", N.peak_token_id("assay", "track_name", "chrom", "start", "end"))
    return experiments.ordered_columns(out, PEAK_TOKENS)


def element_tokens(peaks_: DataFrame, signal: DataFrame, tss: DataFrame, resolution: int, marks: list[str], atac: DataFrame | None = None, block: int = 1 << 16) -> DataFrame:
    """Classified elements, one a peak: mean of each mark over the peak, scores within a chromosome, nearest start, class.

    peaks_: chrom, start, end, summit, and auc and signal_value where known; signal: chrom, name, bin, value; marks: the wanted names (one of
    h3k4me3, h3k27ac and ctcf that isn't among them counts as 0); atac: blocks of the signal by base (chrom, block_idx, values).  Means and
    distances are found once for each distinct interval and summit, so peaks with the same ends are not multiplied.
    """
    scored = ["h3k4me3", "h3k27ac", "ctcf"]
    ends = ["chrom", "start", "end"]
    spans = peaks_.select(*ends).distinct().withColumn("interval_id", F.concat_ws(":", "start", "end"))
    per_mark = spans.select(*ends, "interval_id", F.explode(F.array(*map(F.lit, marks))).alias("name"))
    means = intervals.overlap_mean(per_mark, signal, resolution, ("chrom", "name"))
    rows = peaks_.join(means.groupBy(*ends).pivot("name", marks).agg(F.max("mean_value")), ends)
    if atac is not None:
        rows = rows.join(intervals.block_mean(spans, atac, block).select(*ends, F.col("mean_value").alias("atac_signal")), ends)
    rows = rows.withColumns({c: F.lit(0.0) for c in [*scored, "auc", "signal_value", "atac_signal"] if c not in rows.columns})
    rows = classify.zscore(rows, scored)
    points = rows.select("chrom", F.col("summit").cast("long").alias("pos")).distinct().withColumn("query_id", F.col("pos"))
    near = nearest.nearest_point(points, tss).select("chrom", F.col("pos").alias("summit"), F.col("distance").alias("tss_distance"), F.col("nearest").alias("nearest_gene"))
    rows = rows.join(near, ["chrom", "summit"])
    label = classify.element_class(F.col("h3k4me3_z"), F.col("h3k27ac_z"), F.col("ctcf_z"), F.col("tss_distance"))
    return rows.select(
        N.element_token_id(*ends).alias("token_id"), *ends, "summit", F.col("auc").cast("float").alias("auc"), F.col("signal_value").cast("float").alias("signal_value"), label.alias("ccre_class"),
        "tss_distance", "nearest_gene", F.col("atac_signal").cast("float").alias("atac_signal"), "h3k4me3_z", "h3k27ac_z", "ctcf_z", *marks,
    )


def experiment_peaks(peaks_: DataFrame, segments: DataFrame, info: DataFrame, width: int = 1 << 14) -> DataFrame:
    """Peaks of all experiments at once: summit and area from each one's signal.  peaks_ has accession and the narrowPeak columns;
    segments: accession, chrom, start, end, value; info: accession, target, biosample, assay, and has_signal where known (else those with segments
    have one).  An experiment without a signal has NaN areas, a chromosome that its signal lacks 0."""
    signals = info.where("has_signal").select("accession") if "has_signal" in info.columns else segments.select("accession")
    keys = ["accession", "chrom", "start", "end"]
    spans = peaks_.select(*keys).distinct().withColumn("interval_id", F.concat_ws(":", "start", "end"))
    areas = intervals.interval_auc(spans, segments, width, ("accession", "chrom"), signals)
    rows = experiments.summits(peaks_).join(areas.select(*keys, "auc"), keys).join(info, "accession").withColumn("experiment_accession", F.col("accession"))
    rows = rows.withColumn("token_id", N.peak_token_id(N.assay_slug("assay"), "accession", "chrom", "start", "end"))
    return experiments.ordered_columns(rows, EXPERIMENT_PEAKS)


def of_assay(tokens: DataFrame, assay: str = "atac") -> DataFrame:
    """The tokens of one assay; of a table written by assay only its part is read."""
    return tokens.where(F.col("assay") == assay)
