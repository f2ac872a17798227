"""Contact matrices: dense windows to sparse tokens, row totals, and sparse contact lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.naming import contact_token_id
from strandline.operators.tiling import keep_ranges

MIN_FREQUENCY = 1e-4


def contact_tokens(rows: DataFrame, windows: DataFrame, resolution: int, stride: int, least: float = MIN_FREQUENCY) -> DataFrame:
    """Upper-triangle contacts whose two bins start in the kept part of their window, at least ``least``.

    rows: chrom, window_idx, track, row_idx, row (array); windows: as generate_windows or window_numbers.  Each matrix row is cut to its kept
    part beyond the diagonal before it is exploded.
    """
    kept = keep_ranges(windows, stride).select("chrom", "window_idx", "start", "keep_start", "keep_end")
    low = F.greatest(F.ceil((F.col("keep_start") - F.col("start")) / resolution), F.lit(0).cast("long"))  # a stride may begin before a short window
    high = F.ceil((F.col("keep_end") - F.col("start")) / resolution)
    at = rows.join(kept, ["chrom", "window_idx"]).where((F.col("row_idx") >= low) & (F.col("row_idx") < high))
    n = F.greatest(F.least(high, F.size("row").cast("long")) - F.col("row_idx"), F.lit(0)).cast("int")
    cells = at.select("chrom", "track", "start", "row_idx", F.posexplode(F.slice("row", (F.col("row_idx") + 1).cast("int"), n)).alias("d", "freq"))
    cells = cells.where(F.col("freq") >= F.lit(least).cast(rows.schema["row"].dataType.elementType))
    one = F.col("start") + F.col("row_idx") * resolution
    two = F.col("start") + (F.col("row_idx") + F.col("d")) * resolution
    out = cells.select("chrom", one.alias("bin1_start"), (one + resolution).alias("bin1_end"), two.alias("bin2_start"), (two + resolution).alias("bin2_end"), F.col("freq").alias("contact_freq"), F.col("track").alias("track_name"), F.lit(resolution).alias("resolution"))
    return out.select(contact_token_id("track_name", "chrom", "bin1_start", "bin2_start").alias("token_id"), *out.columns)


def contact_row_totals(rows: DataFrame, windows: DataFrame, resolution: int, least: float = MIN_FREQUENCY) -> DataFrame:
    """Sum of each matrix row's entries of at least ``least`` by genome bin, over all windows (overlaps add up): chrom, track, bin, total."""
    at = rows.join(windows.select("chrom", "window_idx", "start", "chrom_size"), ["chrom", "window_idx"])
    kind = rows.schema["row"].dataType.elementType
    total = F.aggregate(F.filter("row", lambda v: v >= F.lit(least).cast(kind)), F.lit(0.0), lambda a, v: a + v)
    bin_ = F.floor(F.col("start") / resolution) + F.col("row_idx")
    out = at.select("chrom", "track", bin_.alias("bin"), total.alias("t"), "chrom_size").where(F.col("bin") < F.ceil(F.col("chrom_size") / resolution))
    return out.groupBy("chrom", "track", "bin").agg(F.sum("t").alias("total"))


def sparse_contacts(triples: DataFrame, resolution: int | str, chroms: DataFrame, trans: bool = False, least: float = MIN_FREQUENCY) -> DataFrame:
    """Contacts above ``least`` (strictly) and finite, between wanted chromosomes.

    triples: accession, chrom1, bin1, chrom2, bin2, counts; chroms: chrom, ord (their order).  Contacts across chromosomes, taken with
    trans=True, have the earlier chromosome first, whichever way they are stored.  resolution: one for all, or a column of triples.
    """
    a, b = chroms.select(F.col("chrom").alias("chrom1"), F.col("ord").alias("o1")), chroms.select(F.col("chrom").alias("chrom2"), F.col("ord").alias("o2"))
    c = F.col("counts")
    rows = triples.where((c > least) & ~F.isnan(c) & (c < F.lit(float("inf")))).join(F.broadcast(a), "chrom1").join(F.broadcast(b), "chrom2")  # a row a chromosome
    rows = rows if trans else rows.where("o1 = o2")
    wide = F.col(resolution) if isinstance(resolution, str) else F.lit(resolution)
    swap = F.col("o1") > F.col("o2")
    side = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    start1, start2 = side("bin1", "bin2"), side("bin2", "bin1")
    return rows.select(
        "accession", side("chrom1", "chrom2").alias("chrom1"), start1.alias("start1"), (start1 + wide).alias("end1"), side("chrom2", "chrom1").alias("chrom2"),
        start2.alias("start2"), (start2 + wide).alias("end2"), c.alias("contact_freq"), wide.alias("resolution"),
    )


def window_numbers(files: DataFrame) -> DataFrame:
    """Windows known by their files (chrom, start, end; one row a file or more): chrom, start, end, window_idx by start, n_windows.

    A file without tracks has no matrix rows, yet its place: take the windows from sources.arrays.window_files where there may be such.
    """
    each = files.select("chrom", "start", "end").distinct()
    by_start = Window.partitionBy("chrom").orderBy("start", "end")
    return each.withColumn("window_idx", (F.row_number().over(by_start) - 1).cast("long")).withColumn("n_windows", F.count("*").over(Window.partitionBy("chrom")))


def chrom_pairs(chroms: DataFrame) -> DataFrame:
    """All pairs of different chromosomes, the earlier first (a few dozen rows squared)."""
    a, b = chroms.select(F.col("chrom").alias("chrom1"), F.col("ord").alias("o1")), chroms.select(F.col("chrom").alias("chrom2"), F.col("ord").alias("o2"))
    return a.join(b, F.col("o1") < F.col("o2")).select("chrom1", "chrom2")


def nearest_resolution(catalog: DataFrame, wanted: int) -> DataFrame:
    """From (accession, resolution): the resolution nearest to the wanted one, the smaller on a tie; the wanted one where the catalog has none."""
    near = F.min_by("resolution", F.struct(F.abs(F.col("resolution") - wanted), "resolution"))
    return catalog.groupBy("accession").agg(F.coalesce(near, F.lit(wanted)).alias("resolution"))


def preferred_normalisation(catalog: DataFrame, preference: tuple[str, ...] = ("KR", "VC_SQRT", "NONE")) -> DataFrame:
    """From (accession, norm): the first of the preferred ones that it has, else NONE."""
    rank = F.array_position(F.array(*map(F.lit, preference)), F.col("norm"))
    best = F.min(F.when(rank > 0, rank))
    return catalog.groupBy("accession").agg(F.coalesce(F.element_at(F.array(*map(F.lit, preference)), best.cast("int")), F.lit("NONE")).alias("norm"))
