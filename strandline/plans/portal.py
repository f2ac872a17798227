"""The program on experiments of a portal: choice of files, peaks and contacts of all experiments at once, tokens and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import naming as N
from strandline.operators import contacts, experiments
from strandline.plans.pipelines import EXPERIMENT_PEAKS
from strandline.sources import sinks

#: Columns of the contact tokens, in order.
EXPERIMENT_CONTACTS = ["token_id", "chrom1", "start1", "end1", "chrom2", "start2", "end2", "contact_freq", "experiment_accession", "biosample", "resolution"]
PEAK_WHOLE, PEAK_REAL = ("start", "end", "summit"), ("auc", "signal_value", "p_value", "q_value")
CONTACT_WHOLE, CONTACT_REAL = ("start1", "end1", "start2", "end2", "resolution"), ("contact_freq",)


def peak_files(experiments_: DataFrame, assembly: str, base: str) -> DataFrame:
    """Experiments (accession, assay_title, target, biosample, files) with their best peak and signal files; those without peaks go."""
    best = F.struct(experiments.best_peak_file(F.col("files"), assembly).alias("p"), experiments.best_signal_file(F.col("files"), assembly).alias("s"))
    e = experiments_.select("accession", "assay_title", "target", "biosample", F.inline(F.filter(F.array(best), lambda b: b["p"].isNotNull())))  # a filter on p would choose it once more
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return e.select(
        text("accession").alias("accession"), text("assay_title").alias("assay"), "target", "biosample", N.file_url("p.href", base).alias("peak_url"), text("p.accession").alias("peak_accession"),
        text("p.output_type").alias("peak_output_type"), N.file_url("s.href", base).alias("signal_url"), text("s.accession").alias("signal_accession"),
    )


def contact_files(experiments_: DataFrame, assembly: str, base: str) -> DataFrame:
    """Experiments with their contact file, one of the assembly first; those without go."""
    e = experiments_.withColumn("h", experiments.best_contact_file(F.col("files"), assembly)).where("h IS NOT NULL")
    return e.select(F.coalesce("accession", F.lit("")).alias("accession"), "biosample", N.file_url("h.href", base).alias("hic_url"), F.coalesce("h.accession", F.lit("")).alias("hic_accession"))


def attach_paths(experiments_: DataFrame, downloaded: DataFrame) -> DataFrame:
    """Adds peak_path and signal_path from what was downloaded (accession, role, path); null where it wasn't."""
    path = lambda role: F.max(F.when(F.col("role") == role, F.col("path"))).alias(f"{role}_path")
    return experiments_.join(downloaded.groupBy("accession").agg(path("peak"), path("signal")), "accession", "left")


def chosen_matrices(triples: DataFrame, wanted: int, chroms: DataFrame) -> DataFrame:
    """The triples of one resolution (the nearest to the wanted one) and one normalisation (the preferred one) of each source.

    triples: accession, norm, resolution, chrom1, bin1, chrom2, bin2, counts.  The normalisation is decided once a source, from what it has for the
    wanted chromosomes.  What a source has is a few rows, found by one aggregation.  The choice, a row a source, is broadcast: by its keys the triples of a source would all go to one task.
    """
    has = triples.groupBy("accession", "norm", "resolution", "chrom1").agg(F.count("*").alias("n"))
    resolution = contacts.nearest_resolution(has, wanted)
    first = has.join(chroms.select(F.col("chrom").alias("chrom1")), "chrom1", "left_semi")
    norm = contacts.preferred_normalisation(first)
    return triples.join(F.broadcast(resolution.join(norm, "accession")), ["accession", "resolution", "norm"], "left_semi")


def contact_tokens(triples: DataFrame, info: DataFrame, wanted: int, chroms: DataFrame, trans: bool = False, least: float = contacts.MIN_FREQUENCY) -> DataFrame:
    """Contact tokens of all experiments.  info: accession, biosample (a row an experiment, broadcast); chroms: chrom, ord (the wanted ones, in order)."""
    kept = contacts.sparse_contacts(chosen_matrices(triples, wanted, chroms), "resolution", chroms, trans, least)
    return finish_contacts(kept.join(F.broadcast(info.select("accession", "biosample")), "accession").withColumnRenamed("accession", "experiment_accession"))


def _coerced(rows: DataFrame, whole: tuple[str, ...], real: tuple[str, ...]) -> DataFrame:
    """Stable types: what is no whole number is 0, what is no number NaN."""
    casts = {c: N.lenient_long(F.col(c)) for c in whole if c in rows.columns} | {c: N.lenient_float(c) for c in real if c in rows.columns}
    return rows.withColumns(casts)


def finish_peaks(rows: DataFrame) -> DataFrame:
    """Peak tokens in their final form: types, token_id first, missing columns as empty strings."""
    rows = _coerced(rows, PEAK_WHOLE, PEAK_REAL)
    rows = rows.withColumn("token_id", N.peak_token_id(N.assay_slug("assay"), "experiment_accession", "chrom", "start", "end"))
    return experiments.ordered_columns(rows, EXPERIMENT_PEAKS)


def finish_contacts(rows: DataFrame) -> DataFrame:
    rows = _coerced(rows, CONTACT_WHOLE, CONTACT_REAL)
    rows = rows.withColumn("token_id", N.hic_token_id("experiment_accession", "chrom1", "start1", "chrom2", "start2"))
    return experiments.ordered_columns(rows, EXPERIMENT_CONTACTS)


def summarise_all(peaks: DataFrame, contacts_: DataFrame) -> DataFrame:
    """One row an experiment of either kind: assay, experiment_accession, biosample, target, n_tokens, n_chroms, median_auc (NaN for contacts)."""
    hic = contacts_.select(
        F.lit("Hi-C").alias("assay"), "experiment_accession", "biosample", F.lit("").alias("target"), F.col("chrom1").alias("chrom"), F.lit(float("nan")).cast("float").alias("auc")
    )
    return experiments.summarise(peaks.select(*hic.columns).unionByName(hic))


def first_experiments(experiments_: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` experiments (by place) of each assay and biosample; all without a limit."""
    if limit is None:
        return experiments_
    rank = F.row_number().over(Window.partitionBy("assay", "biosample").orderBy("place"))
    return experiments_.withColumn("rank", rank).where(F.col("rank") <= limit).drop("rank")


def write_all(peaks: DataFrame, contacts_: DataFrame, path: str) -> None:
    """All tokens by assay and experiment, and the summary of what was written.  Reading an assay's folder gives its experiments merged."""
    slugged = peaks.withColumn("assay_slug", N.assay_slug("assay"))
    sinks.write_tokens(slugged, f"{path}/peaks", ("assay_slug", "experiment_accession"))
    sinks.write_tokens(contacts_, f"{path}/hi_c", ("experiment_accession",))
    spark = peaks.sparkSession
    summary = summarise_all(sinks.read_tokens(spark, f"{path}/peaks", slugged), sinks.read_tokens(spark, f"{path}/hi_c", contacts_))
    sinks.write_summary(summary.orderBy("assay", "experiment_accession"), f"{path}/summary")
