"""Choice of files from nested experiment documents, experimental peaks, and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators import medians

#: Fixed values, in the order of preference.
PEAK_OUTPUTS = ("IDR thresholded peaks", "optimal IDR thresholded peaks", "pseudoreplicated IDR thresholded peaks")
SIGNAL_OUTPUT = "fold change over control"


def matches_assembly(file: Column, assembly: str) -> Column:
    """assembly is one name, or a list of names: file.assembly (string) or file.assemblies (array)."""
    return F.coalesce(file["assembly"] == assembly, F.lit(False)) | F.coalesce(F.exists(file["assemblies"], lambda a: a == assembly), F.lit(False))


def _first(files: Column, file_type: str, assembly: str | None, rank) -> Column:
    """The released file of a type and assembly with the lowest rank, then place: one pass over the list."""

    def place(f: Column, i: Column) -> Column:
        fits = (f["file_type"] == file_type) & (f["status"] == "released") & (matches_assembly(f, assembly) if assembly else F.lit(True))
        return F.when(fits, F.struct(rank(f).cast("int").alias("rank"), i.alias("place")))

    return F.get(files, F.array_min(F.transform(files, place))["place"])


def best_peak_file(files: Column, assembly: str) -> Column:
    order = F.array(*map(F.lit, PEAK_OUTPUTS))
    rank = lambda f: F.coalesce(F.nullif(F.array_position(order, f["output_type"]), F.lit(0).cast("long")), F.lit(99))
    return _first(files, "bed narrowPeak", assembly, rank)


def best_signal_file(files: Column, assembly: str) -> Column:
    rank = lambda f: F.when(f["output_type"] == SIGNAL_OUTPUT, 0).when(F.lower(f["output_type"]).contains("signal"), 1).otherwise(2)
    return _first(files, "bigWig", assembly, rank)


def best_contact_file(files: Column, assembly: str) -> Column:
    """One of the assembly first, else any released one."""
    return _first(files, "hic", None, lambda f: F.when(matches_assembly(f, assembly), 0).otherwise(1))


def limit_per_group(rows: DataFrame, groups: list[str], order: list[str], n: int) -> DataFrame:
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


def summits(peaks: DataFrame) -> DataFrame:
    """Adds summit: start + offset where the offset is known (not negative), else the middle."""
    return peaks.withColumn("summit", F.when(F.col("peak_offset") >= 0, F.col("start") + F.col("peak_offset")).otherwise(F.floor((F.col("start") + F.col("end")) / 2)))


def summarise(tokens: DataFrame) -> DataFrame:
    """One row an experiment: n_tokens, n_chroms, median_auc (exact, without NaN; NaN where there is no other).

    tokens: assay, experiment_accession, biosample, target, chrom, auc.
    """
    keys = ("assay", "experiment_accession")
    counts = tokens.groupBy(*keys).agg(F.min("biosample").alias("biosample"), F.min("target").alias("target"), F.count("*").alias("n_tokens"), F.countDistinct("chrom").alias("n_chroms"))
    out = medians.null_safe(counts, medians.exact_median(tokens, keys, "auc", "median_auc"), keys, "left")
    return out.withColumn("median_auc", F.coalesce("median_auc", F.lit(float("nan"))))


def ordered_columns(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns in this order; missing ones as empty strings."""
    return rows.select(*(F.col(c) if c in rows.columns else F.lit("").alias(c) for c in columns))


def still_to_do(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose keys aren't done yet."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def download_tasks(experiments: DataFrame) -> DataFrame:
    """One task a file of each experiment (accession, peak_url, signal_url): accession, role, url; missing files give none."""
    pairs = F.filter(F.array(F.struct(F.lit("peak").alias("role"), F.col("peak_url").alias("url")), F.struct(F.lit("signal").alias("role"), F.col("signal_url").alias("url"))), lambda x: x["url"].isNotNull())
    return experiments.select("accession", F.inline(pairs))


def counters(tokens: DataFrame, by: str, distinct: str, area: str = "auc") -> DataFrame:
    """For each value of ``by``: n, n_missing (areas that are NaN), n_tracks (distinct values of ``distinct``)."""
    return tokens.groupBy(by).agg(F.count("*").alias("n"), F.sum(F.isnan(area).cast("long")).alias("n_missing"), F.countDistinct(distinct).alias("n_tracks"))
