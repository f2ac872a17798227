"""Mixing sources to target weights by capped water-filling (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
MAX_EPOCHS = 2
SHARE = 1.5
SEED = "mix-1"
#: Leading digits of the keys that are looked at one after the other; the last is the whole key.
DIGITS = (3, 6, 32)
#: Sources up to this many are broadcast; beyond, the plan is joined by shuffling, where Spark splits the hot source.
BROADCAST_SOURCES = 50_000


def _size(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _key(seed: str) -> Column:
    """Order of the documents within a source: a seeded hash of doc_id, in hexadecimal."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def _source() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))


def water_fill(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = SHARE) -> DataFrame:
    """Targets by source, from rows (source, size): source_key, source_size, target.

    Sources by code point, null last, take the weights in turn.  All share ``share`` times all sizes; a target stops at
    max_epochs times its source's size and the excess goes to the others by weight, until none is above.  With the sources
    ordered by cap / weight, those below the water level are capped, so that two running sums replace the repetition.
    One row per source from here on.
    """
    one = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    one = one.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double").alias("w"))
    one = one.withColumn("cap", F.col("source_size").cast("double") * max_epochs).withColumn("ratio", F.col("cap") / F.col("w"))
    order = Window.orderBy("ratio", F.col("source").isNull(), F.encode("source", "UTF-8"))
    past, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = lambda c: F.coalesce(F.sum(c).over(past), F.lit(0.0))
    rest = F.sum("w").over(everything) - before("w")  # whole numbers, so the difference is exact
    one = one.withColumn("level", (F.sum("source_size").over(everything).cast("double") * share - before("cap")) / rest)
    one = one.withColumn("water", F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"])
    target = F.coalesce(F.least(F.col("cap"), F.col("water") * F.col("w")), F.col("cap"))
    return one.select(_source().alias("source_key"), "source_size", target.alias("target"))


def mixing_plan(sizes: DataFrame, **how) -> DataFrame:
    """How each source is taken: source_key, source_size, target, whole, edge_key, edge_take, edge_size.

    Every document is taken ``whole`` times; those whose key is below edge_key once more; those at it (one document, if ids
    differ) take edge_take words of their edge_size.  Sizes are first summed by the leading digits of the key, then of those keys by some
    digits more, so that only the one small slice of keys that holds the edge is put in order.
    """
    targets = water_fill(sizes, **how)
    words = F.round("target").cast("long")
    targets = targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long"))
    targets = targets.withColumn("extra", words - F.col("whole") * F.col("source_size"))
    rows = sizes.select(_source().alias("source_key"), "size", "key")
    keys = targets.select("source_key", F.lit("").alias("slice"), F.lit(0).cast("long").alias("before"), "extra")
    shorter = 0
    for digits in DIGITS:  # of each source, the slice of keys that holds the edge
        part = rows.join(keys.withColumnRenamed("slice", "outer"), "source_key").where(F.substring("key", 1, shorter) == F.col("outer")) if shorter else rows.join(keys.drop("slice"), "source_key")
        sums = part.groupBy("source_key", F.substring("key", 1, digits).alias("slice"), "before", "extra").agg(F.sum("size").alias("n"))
        upto = Window.partitionBy("source_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(upto), F.lit(0)))
        keys = sums.where((F.col("before") <= F.col("extra")) & (F.col("extra") < F.col("before") + F.col("n")))
        last, shorter = keys, digits
        keys = keys.drop("n")
    edge = last.select("source_key", F.col("slice").alias("edge_key"), (F.col("extra") - F.col("before")).alias("edge_take"), F.col("n").alias("edge_size"))
    return targets.drop("extra").join(edge, "source_key", "left")


def mix_documents(docs: DataFrame, seed: str = SEED, keep: tuple[str, ...] = ("doc_id",), **how) -> DataFrame:
    """Every row of docs (doc_id, text, source): the columns in keep, then size, source_size, target, taken.

    size: words of the text (null: 0).  taken: words that the mix takes of the row, repeats counted; at most max_epochs times
    its size.  The words taken of a source are its target rounded to whole words (less one a row where rows share a doc_id).
    The same seed gives the same mix.  Null sources form one source; rows without words take none; an empty table gives no rows.
    Rows that share a doc_id share a place in the order; where the mix ends there, each takes its part of what is left.  A text of any length counts whole.
    """
    sizes = written(docs.select("doc_id", "source", _size().alias("size"), _key(seed).alias("key")), "sizes")
    plan = written(mixing_plan(sizes, **how), "mix")
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    alone = set(keep) <= {"doc_id"}
    rows = sizes.select("doc_id", _source().alias("source_key"), "size", "key") if alone else docs.select(*keep, _source().alias("source_key"), _size().alias("size"), _key(seed).alias("key"))
    more = F.when(F.col("key") < F.col("edge_key"), F.col("size")).when(F.col("key") == F.col("edge_key"), F.floor(F.col("size") * F.col("edge_take") / F.col("edge_size"))).otherwise(0)
    return rows.join(plan, "source_key").select(*keep, "size", "source_size", "target", (F.col("size") * F.col("whole") + more).cast("long").alias("taken"))
