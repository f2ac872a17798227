"""The composed programs and the streaming form."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strandline import registry
from strandline.plans import pipelines, portal
from strandline.sources import text
from strandline.streaming import bins


def test_peaks_to_elements(spark):
    rng = np.random.default_rng(0)
    x = np.abs(rng.normal(0, 0.01, 400))
    for c in (60, 200, 320):
        x[c - 8 : c + 9] += 3 * np.exp(-np.arange(-8, 9) ** 2 / 18)
    signal = spark.createDataFrame([("c1", 0, i, float(v)) for i, v in enumerate(x)], "chrom string, track int, bin long, value double")
    sizes = spark.createDataFrame([("c1", 400 * 32)], "chrom string, chrom_size long")
    names = spark.createDataFrame([(0, "ATAC x")], "track int, track_name string")
    tokens = pipelines.peak_tokens(signal, names, sizes, "atac", 32, 128)
    assert tokens.columns == pipelines.PEAK_TOKENS
    found = [r["summit"] // 32 for r in tokens.orderBy("summit").collect()]
    assert len(found) == 3 and all(abs(a - b) <= 8 for a, b in zip(found, (60, 200, 320)))
    marks = spark.createDataFrame([("c1", m, i, float((i // 10) % 7 + k)) for k, m in enumerate(("h3k4me3", "h3k27ac", "ctcf")) for i in range(100)], "chrom string, name string, bin long, value double")
    tss = spark.createDataFrame([("c1", 2000, "g", 1)], "chrom string, pos long, name string, ord long")
    elements = pipelines.element_tokens(tokens, marks, tss, 128, ["h3k4me3", "h3k27ac", "ctcf"])
    assert elements.count() == 3 and {r["nearest_gene"] for r in elements.collect()} == {"g"}


def test_predictions(spark):
    def predict(batches):
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([b.column("chrom"), b.column("window_idx"), pa.array(["t"] * n), pa.array([1] * n, pa.int64()), b.column("start").cast(pa.float64())], names=["chrom", "window_idx", "track", "local_bin", "value"])

    sizes = spark.createDataFrame([("a", 100)], "chrom string, chrom_size long")
    out = pipelines.predict_tracks(sizes, predict, "chrom string, window_idx long, track string, local_bin long, value double", 10, 40, 20)
    assert [(r["bin"], r["value"]) for r in out.orderBy("bin").collect()] == [(1, 0.0), (3, 20.0), (5, 40.0)]


def test_experiment_peaks(spark):
    p = spark.createDataFrame([("E", "c", 0, 10, "p", ".", 1.0, 2.0, 3.0, 4)], "accession string, chrom string, start long, end long, name string, strand string, signal_value double, p_value double, q_value double, peak_offset int")
    s = spark.createDataFrame([("E", "c", 0, 5, 2.0)], "accession string, chrom string, start long, end long, value double")
    i = spark.createDataFrame([("E", "CTCF", "K", "TF ChIP-seq")], "accession string, target string, biosample string, assay string")
    r = pipelines.experiment_peaks(p, s, i).first()
    assert (r["token_id"], r["summit"], r["auc"]) == ("tf_chip_seq:E:c:0:10", 4, 20.0)


def test_stream_equals_batch(spark, tmp_path):
    rows = [(f"2024-01-01 0{h}:{m:02d}:00", "click", float(h + m)) for h in range(6) for m in (5, 35)]
    df = spark.createDataFrame(rows, "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = bins.stream_bins(stream).writeStream.format("memory").queryName("bins_out").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.sql("SELECT track, start, value, n FROM bins_out").collect())
    assert got == sorted(tuple(r) for r in bins.stream_bins(df).select("track", "start", "value", "n").collect())


def test_predictor_gets_whole_batches(spark, tmp_path):
    """Each batch comes once and whole, whatever Spark's record batches are; a predictor starts once a task."""
    import pyarrow as pa

    from strandline.operators import tiling
    from strandline.plans import pipelines

    log = str(tmp_path)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:

        def predictor(batches):
            import uuid

            with open(f"{log}/{uuid.uuid4().hex}", "w") as out:  # one file a call
                for b in batches:
                    out.write(f"{b.column('chrom')[0]} {b.column('batch')[0]} {' '.join(map(str, b.column('window_idx').to_pylist()))}\n")
                    yield pa.RecordBatch.from_arrays([b.column("chrom"), b.column("window_idx"), pa.array(["t"] * b.num_rows), pa.array([0] * b.num_rows), pa.array([1.0] * b.num_rows)], names=["chrom", "window_idx", "track", "local_bin", "value"])

        sizes = spark.createDataFrame([("a", 2700), ("b", 100), ("c", 1010)], "chrom string, chrom_size long")
        pipelines.predict_tracks(sizes, predictor, "chrom string, window_idx long, track string, local_bin long, value double", 100, 100, 100, batch=10).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = sorted(line.strip() for f in tmp_path.iterdir() for line in f.read_text().splitlines())
    expect = [f"{c} {k // 10} {' '.join(map(str, range(k, min(k + 10, n))))}" for c, n in (("a", 27), ("b", 1), ("c", 11)) for k in range(0, n, 10)]
    assert got == sorted(expect)


def test_feature_matrices_have_no_cross_join(spark):
    from strandline.plans import matrices

    signal = spark.createDataFrame([("a", t, b, float(t + b)) for t in range(3) for b in range(8)], "chrom string, track_idx int, bin long, value double")
    names = spark.createDataFrame([(0, "Histone ChIP-seq H3K4me3", ""), (1, "Histone ChIP-seq H3K27ac", ""), (2, "Histone ChIP-seq H3K27ac", "")], "track_idx int, name string, transcription_factor string")
    sizes = spark.createDataFrame([("a", 8), ("b", 2)], "chrom string, chrom_size long")
    out = matrices.fixed_bin_tokens({"chip_histone": (signal, names, 1), "atac": (signal.where("track_idx = 0"), names.where("track_idx = 0"), 1)}, sizes, 1)
    plan = out._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert out.columns == ["chrom", "start", "end", "atac", "h3k27ac", "h3k4me3"]
    assert [tuple(r)[3:] for r in out.where("chrom = 'a' AND start < 2").orderBy("start").collect()] == [(0.0, 1.5, 0.0), (1.0, 2.5, 1.0)]
    assert [tuple(r)[3:] for r in out.where("chrom = 'b'").collect()] == [(0.0, 0.0, 0.0)] * 2


def test_tokens_are_evaluated_once_and_split(spark, tmp_path):
    """A counter on the source: one evaluation for Parquet and readable rows; a large partition comes in several files."""
    from pyspark.sql import functions as F

    from strandline.sources import sinks

    met = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            met.add(b.num_rows)
            yield b

    rows = spark.range(60_000).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("token_id"), F.when(F.col("id") % 20 == 0, "small").otherwise("large").alias("chrom"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        sinks.write_tokens(rows.mapInArrow(count, rows.schema), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert met.value == 60_000
    assert len([f for f in (tmp_path / "tokens" / "chrom=large").iterdir() if f.suffix == ".parquet"]) > 2
    assert sinks.read_tokens(spark, str(tmp_path)).count() == 60_000
    first = spark.read.csv(f"{tmp_path}/tsv", sep="\t", header=True).orderBy("token_id").limit(1).first()
    assert first["token_id"] == "t0" and spark.read.csv(f"{tmp_path}/tsv", sep="\t", header=True).count() == sinks.TSV_ROWS


def test_a_killed_run_is_taken_up(spark, tmp_path):
    """Data without a line in the manifest is written again, what is committed isn't looked at."""
    from pyspark.sql import functions as F

    from strandline.sources import sinks

    path = str(tmp_path)
    rows = spark.createDataFrame([(c, k) for c in "abcd" for k in range(5)], "chrom string, v int")
    assert sorted(r["chrom"] for r in sinks.write_missing(rows.where("chrom < 'c'"), path).collect()) == ["a", "b"]
    rows.where("chrom = 'c' AND v < 3").write.mode("append").partitionBy("chrom").parquet(f"{path}/data")  # killed before its commit
    assert {r["chrom"] for r in sinks.read_committed(spark, path, ("chrom",), rows).select("chrom").distinct().collect()} == {"a", "b"}
    changed = rows.withColumn("v", F.when(F.col("chrom") == "a", -1).otherwise(F.col("v")))
    assert sorted(r["chrom"] for r in sinks.write_missing(changed, path).collect()) == ["c", "d"]
    assert sorted(map(tuple, sinks.read_committed(spark, path, ("chrom",), rows).collect())) == sorted(map(tuple, rows.collect()))
    assert sinks.write_missing(rows, path).collect() == []
    assert {(r["chrom"], r["n_rows"]) for r in sinks.committed(spark, path, ("chrom",), rows).collect()} == {(c, 5) for c in "abcd"}


def test_blocks_of_sparse_rows(spark):
    from strandline.operators import blocks

    rows = spark.createDataFrame([("a", 1, 2, 5.0), ("a", 1, 17, 1.0), ("a", 1, 99, 7.0), ("b", 2, 0, 3.0), ("a", 3, 4, None)], "chrom string, track int, bin long, value double")
    sizes = spark.createDataFrame([("a", 18), ("b", 3), ("c", 4)], "chrom string, n_bins long")
    got = {(r["chrom"], r["track"], r["block_idx"]): list(r["values"]) for r in blocks.from_rows(rows, block=8, sizes=sizes).collect()}
    assert got == {("a", 1, 0): [0, 0, 5, 0, 0, 0, 0, 0], ("a", 1, 1): [0.0] * 8, ("a", 1, 2): [0, 1], ("b", 2, 0): [3, 0, 0], ("a", 3, 0): [0.0] * 8, ("a", 3, 1): [0.0] * 8, ("a", 3, 2): [0, 0]}


def test_predictions_are_joined_with_windows_by_shuffling(spark):
    """Windows grow with the genome, though they come from a row a chromosome: neither they nor the predicted values are sent whole through the driver."""

    def predict(batches):
        yield from ()

    sizes = spark.range(1).select(F.lit("a").alias("chrom"), F.lit(100).cast("long").alias("chrom_size"))  # its size is known to Spark
    out = pipelines.predict_tracks(sizes, predict, "chrom string, window_idx long, track string, local_bin long, value double", 10, 40, 20)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_triples_are_not_dealt_by_their_source(spark):
    """The choice of matrices and what is known of a source are broadcast: few sources must not mean few tasks."""
    triples = spark.createDataFrame([("A", "KR", 5000, "c1", 5000 * k, "c2", 0, 9.0) for k in range(20)] + [("A", "NONE", 5000, "c1", 0, "c2", 0, 9.0), ("A", "KR", 25000, "c1", 0, "c2", 0, 9.0)], text.TRIPLES)
    info = triples.select("accession").distinct().withColumn("biosample", F.lit("b"))
    chroms = spark.createDataFrame([("c1", 0), ("c2", 1)], "chrom string, ord int")
    out = portal.contact_tokens(triples, info, 10_000, chroms, True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2  # of what the sources have and what is chosen, some rows a source
    assert "ShuffledHashJoin" not in plan and sorted(r["start1"] for r in out.collect()) == [5000 * k for k in range(20)]


def test_a_large_partition_is_written_by_several_tasks(spark, tmp_path):
    """What is committed is joined without dealing the rows, so that rows of one partition can be split between tasks when they are written."""
    from pathlib import Path

    from strandline.sources import sinks

    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        rows = spark.range(0, 60_000, 1, 6).select(F.lit("a").alias("chrom"), F.sha2(F.col("id").cast("string"), 256).alias("token_id"))
        path = str(tmp_path / "out")
        assert [r["chrom"] for r in sinks.write_missing(rows, path).collect()] == ["a"]
        assert sinks.read_committed(spark, path, ("chrom",), rows).count() == 60_000
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        assert "SortMergeJoin" not in sinks.read_committed(spark, path, ("chrom",), rows)._jdf.queryExecution().executedPlan().toString()
        assert len(list(Path(path, "data").rglob("*.parquet"))) > 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_peak_files_parse_each_page_once(spark):
    """Pages and lists of assemblies are parsed in one place of the plan and nowhere else (F5): a filter on what is chosen took both lists again, at every mention."""
    pages = spark.createDataFrame([("{}",)], "value string").repartition(2)
    plan = portal.peak_files(text.parse_experiments(pages), "GRCh38", "u")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType(StringType") == 1 and plan.count("from_json(StructField(@graph") == 1
    assert plan.count("array_position") == 2  # both mentions of one rank


def test_odd_assemblies_and_targets(spark):
    """What is not parsed as a list or an object would have given nothing: names with brackets, numbers, broken lists, blanks before a list; pages without experiments."""
    odd = ["GRCh38", "", "null", "12", "x[1]", "a{b}", "[", '["hg19"', ' ["hg19", "GRCh38"]', '["GRCh38", {"ncbi_version_name": "T"}]', "[1, null, [2]]", '{"ncbi_version_name": "GRCh38"}', '"[1]"', None]
    targets = ["gone", "{", '{"gene_name": "G"}', '{"label": "L"}', ' {"label": "L"}', '[{"label": "L"}]', '"{}"', None]
    one = [{"accession": "E", "target": t, "files": [{"href": str(i), "assembly": a} for i, a in enumerate(odd)]} for t in targets]
    pages = [json.dumps({"@graph": [*one, None, {"accession": "none", "files": None}]}), "{}", '{"@graph": null}', "no page", None]
    got = text.parse_experiments(spark.createDataFrame([(p,) for p in pages], "value string"))
    plain = spark.createDataFrame([(i, a) for i, a in enumerate(odd)], "i int, a string").select("i", F.from_json("a", "array<string>").alias("n"))
    plain = plain.select("i", F.transform("n", lambda a: F.coalesce(F.get_json_object(a, "$.ncbi_version_name"), a)).alias("n"))
    expected = [r["n"] for r in plain.orderBy("i").collect()]
    rows_ = got.collect()
    assert len(rows_) == len(targets) + 2
    assert [r["target"] for r in rows_] == ["", "", "G", "L", "L", "", "", "", "", ""]
    assert all([f["assemblies"] for f in r["files"]] == expected for r in rows_[: len(targets)])
    assert [r["accession"] for r in rows_[-2:]] == [None, "none"] and [r["files"] for r in rows_[-2:]] == [None, None]


def test_nested_files_shuffle_numbers(spark, tmp_path):
    """Lines are shuffled once, as numbers (F5); equal lines but for their kind stand in the order of their names; missing values are kept."""
    rows_ = [(1, 7, 4, 2, "O", "N"), (1, 8, 5, 1, "F", "R"), (1, 8, 5, 1, "O", "N"), (1, 8, 5, 1, "F", "N"), (1, None, None, None, None, None), (None, 1, 6, 1, "O", "A"), (2, 3, 9, 1, "O", "A")]
    spark.createDataFrame(rows_, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_linestatus string, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    nested = registry._nested_files(spark, str(tmp_path))
    got = {r["accession"]: [tuple(f) for f in r["files"]] for r in nested.collect()}
    assert got[1] == [
        ("bigWig", "released", None, None, None, None), ("bed narrowPeak", "released", "GRCh38", None, "pseudoreplicated IDR thresholded peaks", "/f/1"), ("bigWig", "archived", "GRCh38", None, "pseudoreplicated IDR thresholded peaks", "/f/1"),
        ("bigWig", "released", "GRCh38", None, "pseudoreplicated IDR thresholded peaks", "/f/1"), ("bed narrowPeak", "released", "GRCh38", None, "optimal IDR thresholded peaks", "/f/2"),
    ]
    assert got[2] == [("bed narrowPeak", "released", None, ["hg19"], "fold change over control", "/f/1")]
    assert got[None] == [("bed narrowPeak", "released", None, ["hg19", "GRCh38"], "optimal IDR thresholded peaks", "/f/1")]
    plan = registry._nested_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "bigWig" not in plan[plan.index("Exchange") :]
