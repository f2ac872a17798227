"""Joins of intervals of all lengths against loops, and the number of rows that long ones take."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import intervals as I


def spans(n, size, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        a = rng.randrange(size)
        out.append((rng.choice("ab"), k, a, a + rng.choice([0, 1, 2, 5, 40, 300, size // 2, rng.randrange(1, size)])))
    return out


def test_pieces_are_the_range(spark):
    ranges = [(a, b) for a in range(0, 40) for b in range(a, 75, 3)] + [(0, 10**8), (12345, 99_999_999), (3, 4**13)]
    df = spark.createDataFrame(ranges, "a long, b long").select("a", "b", I.pieces(F.col("a"), F.col("b")).alias("p"))
    for r in df.collect():
        parts = sorted((p["node"] * I.FAN ** p["level"], (p["node"] + 1) * I.FAN ** p["level"]) for p in r["p"])
        assert len(parts) < 100
        at = r["a"]
        for x, y in parts:
            assert x == at
            at = y
        assert at == r["b"]


@pytest.mark.parametrize("resolution", [1, 7])
def test_means_of_long_and_short_intervals(spark, resolution):
    rng = random.Random(resolution)
    signal = {(c, b): rng.randrange(100) / 4 for c in "ab" for b in range(400) if rng.random() < 0.7}
    rows = spans(150, 500 * resolution, 3)
    s = spark.createDataFrame([(c, b, v) for (c, b), v in signal.items()] + [("a", 1000, None)], "chrom string, bin long, value double")
    i = spark.createDataFrame(rows, "chrom string, interval_id long, start long, end long")
    got = {r["interval_id"]: r["mean_value"] for r in I.overlap_mean(i, s, resolution).collect()}
    for c, k, a, b in rows:
        bins = range(a // resolution, max(a // resolution + 1, -(-b // resolution)))
        values = [signal[c, x] for x in bins if (c, x) in signal]
        assert abs(got[k] - (sum(values) / len(values) if values else 0)) < 1e-9


def test_means_of_blocks(spark):
    """Ends in arrays, sums of whole blocks between, absent blocks and a short last one."""
    rng = random.Random(5)
    blocks = {(c, k): [rng.randrange(50) / 2 for _ in range(16 if k < 30 else 5)] for c in "ab" for k in range(31) if (c, k) not in (("a", 3), ("b", 17))}
    rows = spans(150, 520, 8)
    df = spark.createDataFrame([(c, k, v) for (c, k), v in blocks.items()], "chrom string, block_idx long, values array<double>")
    i = spark.createDataFrame(rows, "chrom string, interval_id long, start long, end long")
    got = {r["interval_id"]: r["mean_value"] for r in I.block_mean(i, df, 16).collect()}
    for c, k, a, b in rows:
        values = [blocks[c, x // 16][x % 16] for x in range(a, b) if (c, x // 16) in blocks and x % 16 < len(blocks[c, x // 16])]
        assert abs(got[k] - (sum(values) / len(values) if values else 0)) < 1e-9


@pytest.mark.parametrize("width", [1, 16, 10_000])
def test_pairs_of_mixed_lengths(spark, width):
    left, right = spans(120, 900, 1), spans(140, 900, 2)
    a = spark.createDataFrame(left, "chrom string, l long, start long, end long")
    b = spark.createDataFrame(right, "chrom string, r long, start long, end long")
    got = sorted((r["l"], r["r"], r["start"], r["end"], r["r_start"], r["r_end"], r["overlap"]) for r in I.overlap_pairs(a, b, width).collect())
    assert got == sorted((x[1], y[1], *x[2:], *y[2:], min(x[3], y[3]) - max(x[2], y[2])) for x in left for y in right if x[0] == y[0] and min(x[3], y[3]) > max(x[2], y[2]))
    assert I.overlap_pairs(a.limit(0), b, width).count() == 0


def test_a_long_interval_takes_few_rows(spark):
    """10**8 bases at resolution 1: the rows of the joins are counted by the plan's own explode."""
    i = spark.createDataFrame([("a", 0, 17, 10**8 + 17)], "chrom string, interval_id long, start long, end long")
    assert i.select(F.size(I.pieces(F.col("start"), F.col("end"))).alias("n")).first()["n"] < 100
    s = spark.createDataFrame([("a", b, 1.0 + b % 2) for b in range(0, 10**8, 10**6)], "chrom string, bin long, value double")
    assert abs(I.overlap_mean(i, s, 1).first()["mean_value"] - 1.0) < 1e-9
    segments = spark.createDataFrame([("a", k * 10**7, k * 10**7 + 5, 2.0) for k in range(12)] + [("a", 5 * 10**8, 6 * 10**8, 9.0)], "chrom string, start long, end long, value double")
    assert abs(I.interval_auc(i, segments, 16).first()["auc"] - 2.0 * 10**8) < 1
