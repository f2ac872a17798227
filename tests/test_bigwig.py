"""Binary signals against their text form, and what a filter reads."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import intervals
from strandline.sources import bigwig


def ranges(n=9000, seed=1, width=None):
    rng, out = random.Random(seed), []
    for chrom in ("chr1", "chr10", "chr2"):
        at = 0
        for _ in range(n // 3):
            at += 10 if width else rng.randint(0, 20)
            out.append((chrom, at, at + (width or rng.randint(1, 30)), rng.randint(-50, 50) / 4))
            at = at if width else out[-1][2]
    return out


SIZES = [("chr1", 1_000_000), ("chr10", 1_000_000), ("chr2", 1_000_000), ("chrEmpty", 5)]


@pytest.mark.parametrize("kind,packed,order", [(bigwig.RANGES, True, "<"), (bigwig.STEPS, False, "<"), (bigwig.FIXED, True, ">")])
def test_all_kinds_of_blocks(spark, tmp_path, kind, packed, order):
    rows = ranges(width=None if kind == bigwig.RANGES else 7)
    (tmp_path / "E1.bw").write_bytes(bigwig.encode(SIZES, rows, packed, kind, order))
    (tmp_path / "E2.bigWig").write_bytes(bigwig.encode(SIZES, [], packed, kind, order))
    (tmp_path / "notes.txt").write_text("x")
    got = bigwig.read_bigwig(spark, str(tmp_path), part_bytes=4000)
    assert sorted((r["chrom"], r["start"], r["end"], r["value"]) for r in got.collect()) == sorted(rows)
    assert {r["accession"] for r in got.select("accession").distinct().collect()} == {"E1"} and got.rdd.getNumPartitions() > 2


def test_a_filter_reads_few_blocks(spark, tmp_path):
    rows = ranges(60_000)
    path = tmp_path / "E1.bw"
    path.write_bytes(bigwig.encode(SIZES, rows))
    assert len(bigwig.Index(bigwig.opened(str(path))).blocks) > 100  # several levels of the index
    source = bigwig.read_bigwig(spark, f"file:{path}", part_bytes=2000)
    few = bigwig.read_bigwig(spark, f"file:{path}", "chr10", 50000, 51000, 2000)
    assert sorted((r["start"], r["end"], r["value"]) for r in few.collect()) == sorted(r[1:] for r in rows if r[0] == "chr10" and r[2] > 50000 and r[1] < 51000)
    assert few.rdd.getNumPartitions() < source.rdd.getNumPartitions() / 10
    assert bigwig.read_bigwig(spark, str(path), "chrEmpty").count() == 0
    # filters of one scan say nothing about another scan of the same DataFrame
    assert source.where("value > 0 AND chrom = 'chr2'").count() == sum(r[0] == "chr2" and r[3] > 0 for r in rows) and source.count() == len(rows)


def test_areas_are_those_of_the_text_form(spark, tmp_path):
    rows = ranges(3000)
    (tmp_path / "E1.bw").write_bytes(bigwig.encode(SIZES, rows))
    text = spark.createDataFrame(rows, "chrom string, start long, end long, value double")
    spans = spark.createDataFrame([("chr1", k, k * 37, k * 37 + 5 * (k % 40)) for k in range(300)] + [("chrZ", 900, 1, 9)], "chrom string, interval_id long, start long, end long").where("start < end")
    areas = lambda s: {(r["interval_id"]): round(r["auc"], 6) for r in intervals.interval_auc(spans, s, 64).collect()}
    assert areas(text) == areas(bigwig.read_bigwig(spark, str(tmp_path)).withColumn("value", F.col("value").cast("double")))


def test_other_files_are_an_error(spark, tmp_path):
    (tmp_path / "x.bw").write_bytes(b"\1" * 200)
    with pytest.raises(Exception, match="bigWig"):
        bigwig.read_bigwig(spark, str(tmp_path)).count()
