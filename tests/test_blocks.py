"""Signals as blocks: kernels and peaks against whole tracks, medians against numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import block_peaks, blocks, medians, peaks, smoothing

COLUMNS = ("start", "end", "summit", "auc", "signal_value", "prominence")


def tracks_of_all_kinds():
    rng = np.random.default_rng(7)
    smooth = lambda n, w, d: np.round(np.convolve(rng.random(n + w), np.ones(w) / w, "same")[:n] * 10, d)
    out = [smooth(200, 5, 3), smooth(150, 9, 1) + 1, smooth(97, 3, 0), smooth(64, 4, 2) - 3]
    out += [np.concatenate((np.linspace(1, 9, 80), np.linspace(9, 1, 75))), np.arange(1.0, 60.0), np.array([5.0]), np.array([1.0, 2.0]), np.zeros(20), np.full(30, 2.0)]
    stairs = np.arange(120.0) / 10 + np.tile([0, 0.7, 0], 40)  # every peak is lower than the one on its right, and near it
    flat = np.repeat([0.0, 5, 1, 7, 7, 2, 7, 0.5], 13)
    return [*out, stairs, stairs[::-1], flat, np.abs(np.sin(np.arange(180) / 7)) * 5 + 0.01]


def frame(spark, all_):
    data = [("c%d" % (t % 2), t, k, float(v)) for t, x in enumerate(all_) for k, v in enumerate(x)]
    return spark.createDataFrame(data, "chrom string, track int, bin long, value double")


@pytest.mark.parametrize("block,fan,resolution", [(5, 4, 50), (64, 256, 30), (16, 2, 200)])
def test_peaks_of_blocks_are_those_of_whole_tracks(spark, block, fan, resolution):
    """Tracks without zeros, with plateaus over several blocks, rising for ever, of one bin, negative; hierarchies of several levels."""
    all_ = tracks_of_all_kinds()
    got = {}
    for r in peaks.call_peaks(frame(spark, all_), resolution, block=block, fan=fan).collect():
        got.setdefault(r["track"], []).append(tuple(round(float(r[c]), 6) for c in COLUMNS))
    n = 0
    for t, x in enumerate(all_):
        found = peaks.find_peaks(x, resolution)
        expect = [tuple(round(float(v), 6) for v in row) for row in zip(*(found[c] for c in COLUMNS))]
        assert sorted(got.get(t, [])) == sorted(expect), t
        n += len(expect)
    assert n > 20


def test_no_task_holds_more_than_a_block(spark):
    """What is grouped is a block, a zone of peaks or FAN blocks' extremes; along a track only rows of blocks are ordered."""
    b = blocks.from_rows(frame(spark, tracks_of_all_kinds()), block=8)
    sums, last = block_peaks.summaries(b, 8)
    assert sums.select(F.max(F.size("p_bin")).alias("n")).first()["n"] <= 8 and sums.select(F.max("n").alias("n")).first()["n"] == 8
    tree = block_peaks.Hierarchy(sums, last, ("chrom", "track"), 2)
    assert len(tree.levels) == 5 and all(level.select(F.max(F.size("entries")).alias("n")).first()["n"] <= 2 for level in tree.levels)


def test_a_row_of_peaks_that_wait_for_each_other(spark):
    """Heights that rise over many zones: each peak waits for the next one, and rounds go on until all are settled."""
    rng = np.random.default_rng(1)
    bins = np.cumsum(rng.integers(2, 5, 90))
    for heights in (np.arange(90.0), rng.integers(0, 4, 90).astype(float), np.ones(90)):
        x = np.zeros(int(bins[-1]) + 2)
        x[bins] = heights + 1
        df = spark.createDataFrame([("a", 1, int(b), float(x[b])) for b in bins], "chrom string, track int, bin long, height double")
        got = sorted(r["bin"] for r in block_peaks.suppress(df, 7, 10).collect())
        assert got == peaks._spread(x, bins, 7).tolist()


@pytest.mark.parametrize("block", [15, 40])
def test_kernels_on_blocks(spark, block):
    """Smoothing with halos, pooling and both forms, for tracks shorter than a halo and last blocks of one bin."""
    rng = np.random.default_rng(block)
    all_ = [rng.random(n) for n in (1, 4, block, block + 1, 3 * block + 2, 200)]
    df = frame(spark, all_)
    b = blocks.from_rows(df, block=block)
    sizes = df.groupBy("track").agg(F.max("chrom").alias("chrom"), (F.max("bin") + 1).alias("n_bins"))
    get = lambda d, keep=6: {(r["track"], r["bin"]): round(r["value"], keep) for r in d.collect()}
    by_rows = {}
    for t in range(len(all_)):
        by_rows |= get(smoothing.gaussian_smooth(df.where(F.col("track") == t), sizes.where(F.col("track") == t), 3.0))
    assert get(blocks.to_rows(blocks.smooth(b, 3.0, block), block=block)) == by_rows
    pooled = get(blocks.to_rows(blocks.pool(b, 5, block), block=block // 5))
    assert pooled == {(t, k): round(x[k * 5 : k * 5 + 5].mean(), 6) for t, x in enumerate(all_) for k in range(len(x) // 5)}
    assert get(blocks.to_rows(b, block=block)) == get(df)
    with pytest.raises(ValueError):
        blocks.pool(b, 7, block)
    with pytest.raises(ValueError):
        blocks.with_edges(b, block + 1, block)


def test_exact_medians(spark, monkeypatch):
    """Even and odd numbers, ties, NaN, nulls, infinities, null keys; a coarse sketch, so that brackets matter."""
    rng = np.random.default_rng(2)
    groups = {"odd": rng.random(2001), "even": rng.random(2000), "ties": rng.integers(0, 3, 999).astype(float), "one": np.array([4.0]), "two": np.array([1.0, 2.0]), "same": np.full(500, 7.0),
              "wide": np.exp(rng.normal(size=1500) * 20), "signed": -rng.random(801), None: np.array([3.0, 1.0]), "inf": np.array([1.0, np.inf, np.inf])}
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [("odd", float("nan"))] * 5 + [("odd", None)] * 7 + [("none", None), ("none", float("nan"))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, value double").repartition(7)
    for accuracy in (10_000, 100):
        monkeypatch.setattr(medians, "ACCURACY", accuracy)
        got = {r["key"]: r["median"] for r in medians.exact_median(df, ("key",), "value").collect()}
        assert got == {k: float(np.median(x)) for k, x in groups.items()}
    assert medians.exact_median(df.limit(0), ("key",), "value").collect() == []
