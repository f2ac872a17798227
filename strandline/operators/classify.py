"""Scores within a partition and rule-based classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Score threshold and distances of the classes.
Z_THRESHOLD = 1.64
NEAR, PROXIMAL = 200, 2000


def zscore(rows: DataFrame, columns: list[str], by: str = "chrom", suffix: str = "_z") -> DataFrame:
    """Adds (x - mean) / population standard deviation within each partition; 0 where it deviates by less than 1e-9.

    The moments are aggregated and joined back (a row a partition), so no partition has to stand in one task.
    """
    moments = rows.groupBy(by).agg(*(f(c).alias(f"{c}_{n}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_pop))))
    out = rows.join(moments, by)
    for c in columns:
        out = out.withColumn(c + suffix, F.when(F.col(f"{c}_std") < 1e-9, 0.0).otherwise((F.col(c) - F.col(f"{c}_mean")) / F.col(f"{c}_std")))
    return out.drop(*(f"{c}_{n}" for c in columns for n in ("mean", "std")))


def class_counts(elements: DataFrame) -> DataFrame:
    """How many elements each class has: ccre_class, n."""
    return elements.groupBy("ccre_class").agg(F.count("*").alias("n"))


def element_class(promoter_z: Column, enhancer_z: Column, insulator_z: Column, distance: Column, threshold: float = Z_THRESHOLD) -> Column:
    """Class of a regulatory element from its scores and its distance to the nearest transcription start.  NaN is never high."""
    high = lambda z: F.coalesce(~F.isnan(z) & (z.cast("float") >= F.lit(threshold).cast("float")), F.lit(False))
    p, e, i = high(promoter_z), high(enhancer_z), high(insulator_z)
    return (
        F.when(p & (distance <= NEAR), "PLS").when(p, "DNase-H3K4me3")
        .when(e & (distance <= PROXIMAL), "pELS").when(e, "dELS")
        .when(i, "CTCF-only").otherwise("low-DNase")
    )
