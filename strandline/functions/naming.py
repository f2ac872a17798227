"""Names, identifiers and text fields, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def assay_slug(assay: Column | str) -> Column:
    """Lower case, blanks and hyphens as underscores."""
    return F.translate(F.lower(_col(assay)), " -", "__")


#: What the portal calls an assay.
ASSAY_TITLES = {"TF-ChIP-seq": "TF ChIP-seq", "ATAC-seq": "ATAC-seq", "ChIP-seq": "Histone ChIP-seq", "Hi-C": "intact Hi-C"}


def assay_title(assay: Column | str) -> Column:
    """The portal's name of an assay; null for an unknown one."""
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in ASSAY_TITLES.items() for x in pair)), _col(assay))


def peak_token_id(source: Column | str, track: Column | str, chrom: Column | str, start: Column | str, end: Column | str) -> Column:
    return F.concat_ws(":", *(_col(c).cast("string") for c in (source, track, chrom, start, end)))


def contact_token_id(track: Column | str, chrom: Column | str, start1: Column | str, start2: Column | str) -> Column:
    return F.concat_ws(":", F.lit("contact"), *(_col(c).cast("string") for c in (track, chrom, start1, start2)))


def hic_token_id(accession: Column | str, chrom1: Column | str, start1: Column | str, chrom2: Column | str, start2: Column | str) -> Column:
    return F.concat_ws(":", F.lit("hic"), *(_col(c).cast("string") for c in (accession, chrom1, start1, chrom2, start2)))


def element_token_id(chrom: Column | str, start: Column | str, end: Column | str) -> Column:
    return F.concat_ws(":", F.lit("ccre"), *(_col(c).cast("string") for c in (chrom, start, end)))


def histone_column(name: Column | str, index: Column | str | None = None) -> Column:
    """The first word that begins like a histone mark (H3K27ac), in lower case; else the whole cleaned name; else histone_index."""
    # fixed values: the assay's name before the mark, and what a mark looks like
    clean = F.trim(F.regexp_replace(_col(name), r"(?i)histone\s+chip[-_]?seq\s+", ""))
    mark = F.get(F.filter(F.split(clean, r"\s+"), lambda t: t.rlike(r"^[Hh]\d+[A-Za-z]\d*")), F.lit(0))
    other = F.nullif(F.regexp_replace(F.lower(clean), " ", "_"), F.lit(""))
    number = F.coalesce(_col(index).cast("string") if index is not None else F.lit("0"), F.lit("0"))
    return F.coalesce(F.lower(mark), other, F.concat(F.lit("histone_"), number))


def factor_column(name: Column | str, factor: Column | str, index: Column | str | None = None) -> Column:
    """The factor where given, else the trimmed name without its assay prefixes; lower case, blanks as underscores; else tf_index."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(_col(name), r"^TF ChIP-seq ", ""), r"^ChIP-seq ", ""))  # fixed values
    chosen = F.coalesce(F.nullif(_col(factor), F.lit("")), plain)
    number = F.coalesce(_col(index).cast("string") if index is not None else F.lit("0"), F.lit("0"))
    return F.coalesce(F.nullif(F.regexp_replace(F.lower(chosen), " ", "_"), F.lit("")), F.concat(F.lit("tf_"), number))


def contact_column(track: Column | str, n_tracks: Column | str) -> Column:
    safe = F.lower(F.regexp_replace(_col(track), r"[^A-Za-z0-9_]", "_"))
    return F.when(_col(n_tracks) == 1, F.lit("contact_total")).otherwise(F.concat(F.lit("contact_total_"), safe))


def gtf_attribute(attributes: Column | str, key: str) -> Column:
    """Value of the first field of that key, unquoted; empty where missing."""
    return F.regexp_extract(_col(attributes), rf'(?:^|;)\s*{key}\s+"?([^";]*)"?', 1)


def without_version(identifier: Column | str) -> Column:
    return F.substring_index(_col(identifier), ".", 1)


def strand_position(start: Column | str, end: Column | str, strand: Column | str) -> Column:
    """Transcription start from 1-based, inclusive ends: the first base in the direction of the strand, 0-based."""
    return F.when(_col(strand) == "+", _col(start) - 1).otherwise(_col(end) - 1)


def file_url(href: Column | str, base: str) -> Column:
    return F.when(_col(href).startswith("http"), _col(href)).otherwise(F.concat(F.lit(base), _col(href)))


def url_suffix(url: Column | str) -> Column:
    """All suffixes of the file name in a URL, joined; .bin where it has none."""
    name = F.regexp_extract(F.regexp_replace(_col(url), r"[?#].*$", ""), r"([^/]*)$", 1)
    return F.coalesce(F.nullif(F.regexp_extract(name, r"^\.?[^.]*((?:\.[^.]+)+)$", 1), F.lit("")), F.lit(".bin"))


#: What a number looks like, blanks around it allowed.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def whole_number(text: Column | str) -> Column:
    """The whole part of a number, exact where it is written as a whole one; null if it is no number, not finite or out of range."""
    plain = F.trim(_col(text).cast("string"))
    number = F.when(plain.rlike(_NUMBER), plain)
    return F.coalesce(number.try_cast("bigint"), number.try_cast("double").try_cast("bigint"))


def lenient_long(text: Column | str) -> Column:
    """The whole part of a number, or 0."""
    return F.coalesce(whole_number(text), F.lit(0).cast("bigint"))


def lenient_float(text: Column | str) -> Column:
    """A float, or NaN."""
    plain = F.trim(_col(text).cast("string"))
    number = F.when(plain.rlike(_NUMBER) | plain.rlike(_INFINITE), plain)
    return F.coalesce(number.try_cast("float"), F.lit(float("nan")).cast("float"))


def finite_or_null(value: Column | str) -> Column:
    """For JSON: NaN and infinities as null."""
    v = _col(value)
    return F.when(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), v)


def local_path(root: str, assay: Column | str, accession: Column | str, file_accession: Column | str, url: Column | str) -> Column:
    """Where a downloaded file is kept: root/raw/assay/accession/file with the suffixes of its URL."""
    return F.concat_ws("/", F.lit(root), F.lit("raw"), assay_slug(assay), _col(accession), F.concat(_col(file_accession), url_suffix(url)))
