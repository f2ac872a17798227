"""Array files: ranges of rows in several tasks, streams, odd shapes, and a writer that leaves nothing behind when it fails."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.sources import arrays, npz


def save(path, compressed, **more):
    (np.savez_compressed if compressed else np.savez)(path, **more)


@pytest.mark.parametrize("compressed", [False, True])
def test_tracks_in_ranges(spark, tmp_path, compressed):
    rng = np.random.default_rng(1)
    x = rng.random((1003, 3)).astype(np.float32)
    save(tmp_path / "chr1.npz", compressed, values=x, resolution=np.int32(32), chrom=np.array("chr1"), chrom_size=np.int64(32090))
    save(tmp_path / "chr2.npz", compressed, values=x[:7, 0], resolution=np.int32(32), chrom=np.array("chr2"), chrom_size=np.int64(224))
    save(tmp_path / "chr3.npz", compressed, values=x[:7, :0], resolution=np.int32(32), chrom=np.array("chr3"), chrom_size=np.int64(224))
    got = npz.read_tracks(spark, str(tmp_path), block=50, part_bytes=2000)
    assert got.schema == arrays.read_signal(spark, str(tmp_path)).schema
    cells = {(r["chrom"], r["track_idx"], r["bin"]): r["value"] for r in arrays.long_form(got, 50).collect()}
    assert cells == {("chr1", t, k): float(x[k, t]) for t in range(3) for k in range(1003)} | {("chr2", 0, k): float(x[k, 0]) for k in range(7)}
    assert {(r["resolution"], r["chrom_size"]) for r in got.where("chrom = 'chr1'").collect()} == {(32, 32090)}
    assert (got.rdd.getNumPartitions() > 6) != compressed


@pytest.mark.parametrize("compressed", [False, True])
def test_contacts_in_ranges(spark, tmp_path, compressed):
    rng = np.random.default_rng(2)
    x = rng.random((40, 40, 2)).astype(np.float32)
    save(tmp_path / "chr1_0_40.npz", compressed, values=x, resolution=np.int32(1), track_names=np.array(["a", "b"]))
    save(tmp_path / "chr1_40_80.npz", compressed, values=x, resolution=np.int32(1))
    save(tmp_path / "chr1_80_120.npz", compressed, values=x[:, :, :0], resolution=np.int32(1), track_names=np.array([], dtype="<U1"))
    save(tmp_path / "chr1_120_160.npz", compressed, values=x[0], resolution=np.int32(1))
    save(tmp_path / "other.npz", compressed, values=x, resolution=np.int32(1))
    got = npz.read_contacts(spark, f"file://{tmp_path}", part_bytes=3000, block=8)
    rows = {(r["start"], r["track_name"], r["row_idx"]): r["row"] for r in got.collect()}
    assert rows == {(s, n, k): x[k, :, t].tolist() for s, names in ((0, "ab"), (40, ["contact_track_0", "contact_track_1"])) for t, n in enumerate(names) for k in range(40)}
    assert (got.rdd.getNumPartitions() > 2) != compressed
    old = arrays.read_contacts(spark, str(tmp_path))
    assert {(r["start"], r["track_name"], r["row_idx"]): r["row"] for r in old.collect()} == rows
    files = arrays.window_files(spark.read.format("binaryFile").load(str(tmp_path)).select("path"))
    assert sorted(r["start"] for r in files.collect()) == [0, 40, 80, 120]


def blocks(spark, n=1003, tracks=3, block=50, lose=None):
    x = np.random.default_rng(3).random((n, tracks)).astype(np.float32)
    rows = [(a, c, n * 32 - 5, 32, t, k // block, x[k : k + block, t].tolist()) for a in ("atac", "tf") for c in ("chr1", "chr2") for t in range(tracks) for k in range(0, n, block) if (a, c, t, k) != lose]
    return x, spark.createDataFrame(rows, "assay string, chrom string, chrom_size long, resolution int, track_idx int, block_idx long, values array<double>").repartition(7)


def test_round_trip(spark, tmp_path):
    x, df = blocks(spark)
    npz.write_tracks(df, str(tmp_path))
    npz.write_tracks(df.where("assay = 'tf'"), str(tmp_path))  # once more
    assert sorted(os.path.relpath(os.path.join(d, f), tmp_path) for d, _, fs in os.walk(tmp_path) for f in fs if not f.startswith(".")) == ["atac/chr1.npz", "atac/chr2.npz", "tf/chr1.npz", "tf/chr2.npz"]
    plain = np.load(tmp_path / "atac" / "chr2.npz", allow_pickle=False)
    assert (plain["values"] == x).all() and int(plain["resolution"]) == 32 and str(plain["chrom"]) == "chr2" and int(plain["chrom_size"]) == 1003 * 32 - 5
    got = npz.read_tracks(spark, str(tmp_path / "tf"), block=100, part_bytes=3000)
    assert {(r["chrom"], r["track_idx"], r["bin"]): r["value"] for r in arrays.long_form(got, 100).collect()} == {(c, t, k): float(x[k, t]) for c in ("chr1", "chr2") for t in range(3) for k in range(1003)}
    names = spark.createDataFrame([("tf", "chr1", 1, "b", float("nan")), ("tf", "chr1", 0, "a", 1.5)], "assay string, chrom string, track_idx int, name string, weight double")
    npz.write_track_names(names, str(tmp_path))
    listed = arrays.read_track_names(spark, str(tmp_path / "tf" / "chr1.json")).orderBy("track_idx").collect()
    assert [(r["track_idx"], r["name"]) for r in listed] == [(0, "a"), (1, "b")] and "null" in listed[1]["extra"]


@pytest.mark.parametrize("lost", [("tf", "chr2", 1, 500), ("tf", "chr2", 2, 1000)])
def test_a_failed_task_leaves_nothing(spark, tmp_path, lost):
    """One file lacks a block of a track, or its last bins: no file of the job appears, nor anything of its tasks."""
    _, df = blocks(spark, lose=lost)
    with pytest.raises(Exception, match="chr2"):
        npz.write_tracks(df, str(tmp_path / "out"))
    assert [f for _, _, fs in os.walk(tmp_path) for f in fs] == []
