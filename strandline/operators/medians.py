"""Exact medians of groups of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Of the sketch that brackets the median: its error is a group's size over this, and the bracket is MARGIN such errors to both sides.
ACCURACY = 10_000
MARGIN = 5


def null_safe(left: DataFrame, right: DataFrame, keys: tuple[str, ...], how: str = "inner") -> DataFrame:
    """An equi-join on keys where nulls are equal; the keys are left's."""
    named = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = reduce(Column.__and__, (left[k].eqNullSafe(named[f"_{k}"]) for k in keys))
    return left.join(named, on, how).drop(*(f"_{k}" for k in keys))


def exact_median(rows: DataFrame, keys: tuple[str, ...], value: str, name: str = "median") -> DataFrame:
    """keys and the median of each group's values, of an even number the mean of the middle two; nulls and NaN don't count, a group without values has no row.

    A sketch brackets the median; a second pass counts what is below the bracket, and the values in it, each once with its number.  So nothing holds the
    values of a group: what is ordered is the bracket's values, some thousandth of them, and Spark can spill it.  An error, should a bracket miss.
    """
    plain = rows.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    off = MARGIN / ACCURACY
    ends = plain.groupBy(*keys).agg(F.percentile_approx("_v", [0.5 - off, 0.5 + off], ACCURACY).alias("_q"), F.count("*").alias("_n"))
    near = null_safe(plain, ends, keys).where(F.col("_v") <= F.col("_q")[1])
    counts = near.groupBy(*keys, "_n", F.when(F.col("_v") >= F.col("_q")[0], F.col("_v")).alias("_v")).agg(F.count("*").alias("_c"))  # null: all below
    along = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("_upto", F.sum("_c").over(along)).where("_v IS NOT NULL")
    holds = lambda r: (F.col("_upto") > r) & (F.col("_upto") - F.col("_c") <= r)
    at = lambda r: F.max(F.when(holds(r), F.col("_v")))
    low, high = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    found = upto.groupBy(*keys).agg(at(low).alias("_a"), at(high).alias("_b"))
    return found.select(*keys, F.coalesce((F.col("_a") + F.col("_b")) / 2, F.raise_error(F.lit("a sketch missed the median")).cast("double")).alias(name))
