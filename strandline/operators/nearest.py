"""Nearest-point joins and the table of transcription starts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nearest_point(queries: DataFrame, points: DataFrame, key: str = "chrom", width: int = 1 << 20) -> DataFrame:
    """For each query (key, query_id, pos) the nearest of points (key, pos, name, ord): adds distance, nearest.

    On a tie the left point wins; among points at one place the last (by ord) counts to the left, the first to the right.  A
    key without points gives -1 and "".  Positions are cut into blocks of ``width``; the neighbours are running values within a
    block, and for its edges those of a table with a row a block, so that a long or crowded key is spread over tasks.
    """
    block = F.floor(F.col("pos") / width).alias("block")
    point = F.struct(F.col("pos").cast("long").alias("pos"), F.col("ord").cast("long").alias("ord"), "name")
    none = F.lit(None).cast("struct<pos:bigint,ord:bigint,name:string>")
    both = queries.select(key, block, F.col("pos").cast("long").alias("pos"), F.lit(0).alias("kind"), "query_id", none.alias("p"))
    both = both.unionByName(points.select(key, block, F.col("pos").cast("long").alias("pos"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("query_id"), point.alias("p")))

    blocks = both.groupBy(key, "block").agg(F.max("p").alias("last"), F.min("p").alias("first"))
    before = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(key).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    edges = blocks.select(key, "block", F.last("last", True).over(before).alias("far_left"), F.last("first", True).over(after).alias("far_right"))

    ahead = Window.partitionBy(key, "block").orderBy("pos", "kind", "p.ord").rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy(key, "block").orderBy(F.desc("pos"), F.desc("kind"), F.desc("p.ord")).rowsBetween(Window.unboundedPreceding, -1)
    rows = both.withColumn("near_left", F.last("p", True).over(ahead)).withColumn("near_right", F.last("p", True).over(back)).where("kind = 0").join(edges, [key, "block"])
    rows = rows.withColumn("left", F.coalesce("near_left", "far_left")).withColumn("right", F.coalesce("near_right", "far_right"))
    dl, dr = F.col("pos") - F.col("left.pos"), F.col("right.pos") - F.col("pos")
    use_left = F.col("left").isNotNull() & (F.col("right").isNull() | (dl <= dr))
    distance = F.when(use_left, dl).otherwise(dr)
    name = F.when(use_left, F.col("left.name")).otherwise(F.col("right.name"))
    return rows.select(key, "query_id", "pos", F.coalesce(distance, F.lit(-1)).cast("long").alias("distance"), F.coalesce(name, F.lit("")).alias("nearest"))


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: the values of the last line, and first_line, the place of its first."""
    others = [c for c in rows.columns if c not in (key, order)]
    out = rows.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("v"), F.min(order).alias("first_line"))
    return out.select(key, *(F.col(f"v.{c}").alias(c) for c in others), "first_line")


def representatives(transcripts: DataFrame) -> DataFrame:
    """One transcript a gene: the first flagged one (is_mane), else the longest (span), the earliest of equals (first_line)."""
    order = [F.desc("is_mane"), F.when(F.col("is_mane"), 0).otherwise(-F.col("span")), "first_line"]
    return transcripts.withColumn("rank", F.row_number().over(Window.partitionBy("gene_id").orderBy(*order))).where("rank = 1").drop("rank")


def tss_table(gtf: DataFrame, all_tags: bool = False) -> DataFrame:
    """Transcription starts (chrom, pos, name, ord) from parsed annotation lines (see sources.annotation)."""
    flag = F.col("attributes").rlike(r'(?:^|;)\s*tag\s+"?[^";]*MANE[_ ]Select') if all_tags else F.col("first_tag").rlike("MANE[_ ]Select")
    rows = gtf.withColumn("is_mane", F.coalesce(flag, F.lit(False))).withColumn("span", F.col("end") - F.col("start"))
    once = last_wins(rows.select("transcript_id", "gene_id", "gene_name", "chrom", "tss", "is_mane", "span", "line_no"), "transcript_id", "line_no")
    genes = once.groupBy("gene_id").agg(F.min("first_line").alias("ord"))
    return representatives(once).join(genes, "gene_id").select("chrom", F.col("tss").alias("pos"), F.col("gene_name").alias("name"), "ord")
