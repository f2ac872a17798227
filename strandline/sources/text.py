"""Parsers of line formats.  Each takes a DataFrame with a string column ``value``, as spark.read.text gives (gzip included)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.naming import gtf_attribute, lenient_float, lenient_long, strand_position, whole_number, without_version

#: The columns of a narrowPeak line and their types.
NARROW_PEAK = (
    ("chrom", "string"), ("start", "bigint"), ("end", "bigint"), ("name", "string"), ("score", "int"), ("strand", "string"),
    ("signal_value", "float"), ("p_value", "float"), ("q_value", "float"), ("peak_offset", "int"),
)


def parse_narrow_peak(lines: DataFrame, lenient: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """narrowPeak lines as typed columns; comment, header and blank lines go, white space around a line too; short lines are filled up with -1.

    Whole numbers are cut from any number (12.7 is 12); what is none is an error unless lenient (then 0); a malformed float is NaN.
    """
    kept = lines.withColumn("_line", F.regexp_replace("value", r"(?U)^\s+|\s+$", "")).where(~F.col("_line").rlike(r"^(#|track|browser)|^$"))
    parts = F.split("_line", "\t")
    filled = F.concat(parts, F.array_repeat(F.lit("-1"), F.greatest(F.lit(len(NARROW_PEAK)) - F.size(parts), F.lit(0))))
    rows = kept.select(*extra, filled.alias("p"))

    def column(k: int, name: str, kind: str):
        raw = F.get("p", F.lit(k))
        if kind == "string":
            return raw.alias(name)
        if kind == "float":
            return lenient_float(raw).alias(name)
        strict = F.coalesce(whole_number(raw), F.raise_error(F.concat(F.lit(f"no whole number in column {name}: "), raw)).cast("bigint"))
        return (lenient_long(raw) if lenient else strict).cast(kind).alias(name)

    return rows.select(*extra, *(column(k, n, t) for k, (n, t) in enumerate(NARROW_PEAK)))


def parse_annotation(lines: DataFrame) -> DataFrame:
    """Transcript lines of a gene annotation (value, line_no): chrom, start (0-based), end, strand, tss, ids, name, first tag."""
    parts = lines.where(~F.col("value").startswith("#")).select("line_no", F.split("value", "\t").alias("p"))
    rows = parts.where((F.size("p") >= 9) & (F.get("p", F.lit(2)) == "transcript"))
    start, end, strand, attributes = F.get("p", F.lit(3)).cast("bigint"), F.get("p", F.lit(4)).cast("bigint"), F.get("p", F.lit(6)), F.get("p", F.lit(8))
    gene = without_version(gtf_attribute(attributes, "gene_id"))
    return rows.select(
        "line_no", F.get("p", F.lit(0)).alias("chrom"), (start - 1).alias("start"), end.alias("end"), strand.alias("strand"), strand_position(start, end, strand).alias("tss"),
        gene.alias("gene_id"), without_version(gtf_attribute(attributes, "transcript_id")).alias("transcript_id"),
        F.coalesce(F.nullif(gtf_attribute(attributes, "gene_name"), F.lit("")), gene).alias("gene_name"), gtf_attribute(attributes, "tag").alias("first_tag"), attributes.alias("attributes"),
    )


def read_narrow_peak(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    return parse_narrow_peak(spark.read.text(path).withColumn("file", F.col("_metadata.file_path")), lenient, ("file",))


def read_annotation(spark: SparkSession, path: str) -> DataFrame:
    """A gene annotation file (some 50 MB).  It is read whole, since its order counts and text splits carry no line numbers."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("line_no", "value"))
    return parse_annotation(lines.withColumn("line_no", F.col("line_no").cast("long")))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """bedGraph lines: chrom, start, end, value."""
    return spark.read.schema("chrom string, start bigint, end bigint, value double").csv(path, sep="\t", comment="#")


#: Columns of contact lists in text form.
TRIPLES = "accession string, norm string, resolution int, chrom1 string, bin1 bigint, chrom2 string, bin2 bigint, counts float"


def read_contact_triples(spark: SparkSession, path: str) -> DataFrame:
    """Sparse contacts as tab-separated text (TRIPLES): every matrix of a source, by normalisation and resolution; the pseudo-chromosome "all" goes."""
    return real_chromosomes(spark.read.schema(TRIPLES).csv(path, sep="\t", comment="#"))


def real_chromosomes(triples: DataFrame) -> DataFrame:
    return triples.where("lower(chrom1) != 'all' AND lower(chrom2) != 'all'")


def contact_catalog(triples: DataFrame) -> DataFrame:
    """What each source has: accession, resolutions (ascending), norms, chroms."""
    return triples.groupBy("accession").agg(
        F.array_sort(F.collect_set("resolution")).alias("resolutions"), F.array_sort(F.collect_set("norm")).alias("norms"),
        F.array_sort(F.array_union(F.collect_set("chrom1"), F.collect_set("chrom2"))).alias("chroms"),
    )


def read_experiments(spark: SparkSession, path: str) -> DataFrame:
    """Saved search pages ({"@graph": [...]}): accession, assay_title, target, biosample, files (with assembly as one name or a list)."""
    return parse_experiments(spark.read.text(path, wholetext=True))


def parse_experiments(pages: DataFrame) -> DataFrame:
    """read_experiments for pages as JSON texts in a column ``value``."""
    file = "struct<accession:string,file_type:string,status:string,assembly:string,output_type:string,href:string>"
    schema = f"`@graph` array<struct<accession:string,assay_title:string,target:string,biosample_ontology:struct<term_name:string>,files:array<{file}>>>"
    # only lists and objects are parsed as such: a plain name would be read up to its error, which costs more than all the rest
    within = lambda a, key: F.when(a.contains("{"), F.get_json_object(a, f"$.{key}"))
    names = lambda f: F.when(f["assembly"].contains("["), F.from_json(f["assembly"], "array<string>"))
    file_ = lambda f: f.withField("assemblies", F.transform(names(f), lambda a: F.coalesce(within(a, "ncbi_version_name"), a)))
    experiment = lambda e: F.struct(
        e["accession"].alias("accession"), e["assay_title"].alias("assay_title"), F.coalesce(within(e["target"], "gene_name"), within(e["target"], "label"), F.lit("")).alias("target"),
        F.coalesce(e["biosample_ontology"]["term_name"], F.lit("")).alias("biosample"), F.transform(e["files"], file_).alias("files"),
    )
    # all of it inside the generator: what is computed after it, a filter further on would compute once more for each mention
    return pages.select(F.inline(F.transform(F.from_json("value", schema)["@graph"], experiment)))
