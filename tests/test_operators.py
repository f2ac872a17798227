"""Golden cases and brute-force comparisons of the core operators."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.functions import naming
from strandline.functions import naming as N
from strandline.operators import binning, classify, contacts, experiments, intervals, nearest, peaks, smoothing, tiling
from strandline.plans import pipelines, portal
from strandline.sources import arrays, sinks, text

CHR = {"chr1": 248956422, "chr21": 46709983, "chr22": 50818468, "chrY": 57227415}


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_window_counts(spark):
    sizes = spark.createDataFrame(list(CHR.items()), "chrom string, chrom_size long")
    got = dict(tiling.generate_windows(sizes).groupBy("chrom").count().collect())
    assert got == {"chr1": 474, "chr21": 89, "chr22": 96, "chrY": 109}


def test_tiles_and_kept_parts(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 3)], "chrom string, chrom_size long")
    w = tiling.generate_windows(sizes, 4, 2)
    assert rows(w.select("chrom", "start", "end"), "chrom", "start") == [("a", 0, 4), ("a", 2, 6), ("a", 4, 8), ("a", 6, 10), ("b", 0, 3)]
    k = tiling.keep_ranges(w, 2).where("chrom = 'a'").select("keep_start", "keep_end")
    assert rows(k, "keep_start") == [(0, 2), (3, 5), (5, 7), (8, 10)]
    g = rows(tiling.keep_ranges(w, 2, gapless=4).where("chrom = 'a'").select("keep_start", "keep_end"), "keep_start")
    assert g == [(0, 3), (3, 5), (5, 7), (7, 10)]


@pytest.mark.parametrize("window, stride", [(0, 1), (4, 0), (4, 5)])
def test_tiling_rejects(spark, window, stride):
    with pytest.raises(ValueError):
        tiling.generate_windows(spark.createDataFrame([("a", 10)], "chrom string, chrom_size long"), window, stride)


def test_stitch_matches_direct_placement(spark):
    rng = np.random.default_rng(1)
    size, window, stride, res = 1003, 256, 128, 10
    sizes = spark.createDataFrame([("a", size)], "chrom string, chrom_size long")
    w = tiling.generate_windows(sizes, window, stride)
    plan = [r.asDict() for r in w.orderBy("window_idx").collect()]
    data, expect, n = [], {}, len(plan)
    for r in plan:
        a, b = r["start"], r["end"]
        x = rng.integers(1, 99, -(-(b - a) // res))
        data += [("a", r["window_idx"], "t", i, float(v)) for i, v in enumerate(x)]
        i = r["window_idx"]
        ks, ke = (a, min(a + stride, b)) if i == 0 else (max(b - stride, a), b) if i == n - 1 else (a + (b - a - stride) // 2, a + (b - a - stride) // 2 + stride)
        low, high = (ks - a) // res, min(-(-min(ke - a, b - a) // res), len(x))
        for k in range(low, high):
            at = (a + low * res) // res + k - low
            if at < -(-size // res):
                expect[at] = float(x[k])
    values = spark.createDataFrame(data, "chrom string, window_idx long, track string, local_bin long, value double")
    got = {r["bin"]: r["value"] for r in tiling.stitch(values, w, res, stride).collect()}
    assert got == expect


def signal(spark, values, track="t"):
    return spark.createDataFrame([("a", track, i, float(v)) for i, v in enumerate(values)], "chrom string, track string, bin long, value double")


def sizes(spark, n):
    return spark.createDataFrame([("a", n, n)], "chrom string, chrom_size long, n_bins long")


def test_pooling(spark):
    s = signal(spark, [1, 2, 3, 4, 5])
    assert rows(binning.mean_pool(s, sizes(spark, 5), 2).select("bin", "value"), "bin") == [(0, 1.5), (1, 3.5)]
    aligned = binning.align_bins(s, sizes(spark, 5), 1, 2).select("chrom", "bin", F.lit("x").alias("name"), "value")
    m = binning.feature_matrix(aligned, sizes(spark, 5), 2, ["x"])
    assert rows(m.select("start", "end", "x"), "start") == [(0, 2, 1.5), (2, 4, 3.5), (4, 5, 0.0)]
    with pytest.raises(ValueError):
        binning.align_bins(s, sizes(spark, 5), 4, 2)


def test_duplicate_tracks(spark):
    t = spark.createDataFrame([("a", "h", 0, i, v) for i, v in ((2, 4.0), (0, 1.0), (1, 2.0))], "chrom string, name string, bin long, track_idx int, value double")
    assert binning.merge_tracks(t, "pairwise").first()["value"] == 2.75
    assert binning.merge_tracks(t).first()["value"] == pytest.approx(7 / 3)


@pytest.mark.parametrize("n", [1, 5, 12, 13, 40])
def test_smoothing(spark, n):
    x = np.random.default_rng(n).random(n)
    w = np.array(smoothing.gaussian_weights(3.0))
    assert len(w) == 25 and w[12] == pytest.approx(0.1329845, abs=1e-7) and w[0] == pytest.approx(4.4611e-05, abs=1e-8)
    at = lambda k: (k % (2 * n)) if (k % (2 * n)) < n else 2 * n - 1 - (k % (2 * n))
    expect = [sum(w[d + 12] * x[at(i + d)] for d in range(-12, 13)) for i in range(n)]
    for block in (16, 1 << 14):
        got = [r["value"] for r in smoothing.gaussian_smooth(signal(spark, x), sizes(spark, n), block=block).orderBy("bin").collect()]
        assert got == pytest.approx(expect)


def brute_peaks(x, resolution, distance_bp=200):
    """Straight from the definitions, by scanning."""
    n = len(x)
    found, i = [], 1
    while i < n - 1:
        if x[i - 1] < x[i]:
            j = i
            while j < n - 1 and x[j + 1] == x[i]:
                j += 1
            if j < n - 1 and x[j + 1] < x[i]:
                found.append((i + j) // 2)
            i = j
        i += 1
    d = max(1, -(-distance_bp // resolution))
    left = []
    for p in sorted(found, key=lambda p: (-x[p], -p)):
        if all(abs(p - q) >= d for q in left):
            left.append(p)
    out = []
    least = max(0.5 * float(np.median([v for v in x if v > 0])), 1e-4)
    for p in sorted(left):
        a = p
        while a > 0 and x[a - 1] <= x[p]:
            a -= 1
        b = p
        while b < n - 1 and x[b + 1] <= x[p]:
            b += 1
        prom = x[p] - max(min(x[a : p + 1]), min(x[p : b + 1]))
        if prom < least:
            continue
        h = x[p] - prom * 0.5
        i = p
        while i > 0 and x[i] > h:
            i -= 1
        lip = i + ((h - x[i]) / (x[i + 1] - x[i]) if x[i] < h else 0)
        j = p
        while j < n - 1 and x[j] > h:
            j += 1
        rip = j - ((h - x[j]) / (x[j - 1] - x[j]) if x[j] < h else 0)
        if rip - lip < 2:
            continue
        lo = int(np.floor(lip))
        hi = min(max(int(np.ceil(rip)), lo + 1), n)
        area = sum((x[k] + x[k + 1]) / 2 for k in range(lo, hi - 1)) * resolution
        out.append((lo * resolution, hi * resolution, p * resolution, area, x[p], prom))
    return out


@pytest.mark.parametrize("resolution", [32, 128, 200])
def test_peaks_match_brute_force(resolution):
    rng = np.random.default_rng(resolution)
    for _ in range(40):
        x = np.round(np.convolve(rng.random(120), np.ones(5) / 5, "same") * 10, rng.integers(0, 3)).astype(float)
        if not (x > 0).any():
            continue
        got = peaks.find_peaks(x, resolution)
        cols = [got[c] for c in ("start", "end", "summit", "auc", "signal_value", "prominence")]
        assert [tuple(np.round(r, 6)) for r in zip(*cols)] == [tuple(np.round(r, 6)) for r in brute_peaks(x.tolist(), resolution)]


def test_peaks_in_spark(spark):
    x = [0, 1, 8, 9, 8, 1, 0, 0, 2, 5, 5, 5, 2, 0]
    got = peaks.call_peaks(signal(spark, x), 200)
    assert [r["summit"] for r in got.orderBy("summit").collect()] == [600, 2000]
    assert rows(peaks.local_maxima(signal(spark, x)).select("bin", "value"), "bin") == [(3, 9.0), (10, 5.0)]
    assert peaks.call_peaks(signal(spark, [0, 0, 0]), 200).count() == 0
    assert peaks.call_peaks(signal(spark, []), 200).count() == 0


def test_overlap_touches_a_bin(spark):
    s = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 3.0), ("a", 2, 5.0)], "chrom string, bin long, value double")
    i = spark.createDataFrame([("a", 1, 130, 140), ("a", 2, 100, 300), ("a", 3, 900, 901)], "chrom string, interval_id long, start long, end long")
    assert rows(intervals.overlap_mean(i, s, 128).select("interval_id", "mean_value"), "interval_id") == [(1, 3.0), (2, 3.0), (3, 0.0)]


def test_overlap_pairs_match_brute_force(spark):
    rng = np.random.default_rng(4)
    make = lambda n: [("ab"[rng.integers(2)], int(k), int(a := rng.integers(0, 300)), int(a + rng.integers(0, 60))) for k in range(n)]
    a, b = make(60), make(60)
    left = spark.createDataFrame(a, "chrom string, l long, start long, end long")
    right = spark.createDataFrame(b, "chrom string, r long, start long, end long")
    got = {(r["l"], r["r"], r["overlap"]) for r in intervals.overlap_pairs(left, right, 16).collect()}
    expect = {(x[1], y[1], min(x[3], y[3]) - max(x[2], y[2])) for x in a for y in b if x[0] == y[0] and min(x[3], y[3]) > max(x[2], y[2])}
    assert got == expect


def test_area_of_partly_covered_interval(spark):
    s = spark.createDataFrame([("a", 0, 5, 2.0)], "chrom string, start long, end long, value double")
    i = spark.createDataFrame([("a", 1, 0, 10), ("a", 2, 6, 9), ("z", 3, 0, 4)], "chrom string, interval_id long, start long, end long")
    got = {r["interval_id"]: r["auc"] for r in intervals.interval_auc(i, s, 4).collect()}
    assert got == {1: 20.0, 2: 0.0, 3: 0.0}
    of = lambda df, name: df.withColumn("accession", F.lit(name))
    both = of(i, "E").unionByName(of(i, "none"))
    got = {(r["accession"], r["interval_id"]): r["auc"] for r in intervals.interval_auc(both, of(s, "E"), 4, ("accession", "chrom"), of(s, "E").select("accession")).collect()}
    assert [got["E", k] for k in (1, 2, 3)] == [20.0, 0.0, 0.0] and all(np.isnan(got["none", k]) for k in (1, 2, 3))


def test_block_mean(spark):
    b = spark.createDataFrame([("a", k, [float(8 * k + j) for j in range(8 if k < 2 else 3)]) for k in range(3)], "chrom string, block_idx long, values array<double>")
    i = spark.createDataFrame([("a", 1, 3, 12), ("a", 2, 18, 30), ("a", 3, 40, 50), ("a", 4, 5, 5)], "chrom string, interval_id long, start long, end long")
    assert rows(intervals.block_mean(i, b, 8).select("interval_id", "mean_value"), "interval_id") == [(1, 7.0), (2, 18.0), (3, 0.0), (4, 0.0)]


def test_nearest_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    p = [("ab"[rng.integers(2)], int(rng.integers(0, 40)), f"g{k}", k) for k in range(30)]
    q = [("abz"[rng.integers(3)], k, int(rng.integers(-5, 50))) for k in range(60)]
    found = [nearest.nearest_point(spark.createDataFrame(q, "chrom string, query_id long, pos long"), spark.createDataFrame(p, "chrom string, pos long, name string, ord long"), width=w).collect() for w in (7, 1 << 20)]
    got, again = ({r["query_id"]: (r["distance"], r["nearest"]) for r in x} for x in found)
    assert got == again
    for c, k, pos in q:
        mine = sorted((x for x in p if x[0] == c), key=lambda x: (x[1], x[3]))
        left = [x for x in mine if x[1] < pos][-1:]
        right = [x for x in mine if x[1] >= pos][:1]
        near = min(left + right, key=lambda x: abs(x[1] - pos), default=None)
        assert got[k] == ((abs(near[1] - pos), near[2]) if near else (-1, ""))


def test_transcripts(spark):
    line = lambda n, chrom, a, b, strand, attrs: (n, "\t".join([chrom, "s", "transcript", str(a), str(b), ".", strand, ".", attrs]))
    lines = [
        (0, "#x"),
        line(1, "c", 11, 20, "+", 'gene_id "G1.2"; transcript_id "T1.1"; gene_name "N";'),
        line(2, "c", 1, 10, "-", 'gene_id "G1.2"; transcript_id "T2.1";'),
        line(3, "c", 1, 5, "-", 'gene_id "G2"; transcript_id "T3"; tag "MANE_Select"; tag "basic";'),
        line(4, "c", 1, 90, "+", 'gene_id "G2"; transcript_id "T4"; tag "basic"; tag "MANE_Select";'),
        (5, "c\ts\tgene\t1\t2\t.\t+\t.\tx"),
    ]
    got = rows(nearest.tss_table(text.parse_annotation(spark.createDataFrame(lines, "line_no long, value string"))), "ord")
    assert got == [("c", 10, "N", 1), ("c", 4, "G2", 3)]


def test_classes(spark):
    nan = float("nan")
    cases = [((2, 0, 0, 200), "PLS"), ((2, 0, 0, 201), "DNase-H3K4me3"), ((0, 2, 0, 2000), "pELS"), ((0, 2, 0, 2001), "dELS"), ((0, 0, 2, 9), "CTCF-only"), ((nan, nan, nan, 1), "low-DNase"), ((1.64, 0, 0, -1), "PLS")]
    df = spark.createDataFrame([(*map(float, c[:3]), c[3], e) for c, e in cases], "a double, b double, c double, d long, e string")
    assert all(r[0] == r[1] for r in df.select(classify.element_class(F.col("a"), F.col("b"), F.col("c"), F.col("d")), "e").collect())


def test_zscore(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 7.0), ("b", 7.0)], "chrom string, x double")
    got = [r["x_z"] for r in classify.zscore(df, ["x"]).orderBy("chrom", "x").collect()]
    assert got == pytest.approx([-1.2247449, 0, 1.2247449, 0, 0])


def test_contacts(spark):
    n = 6
    m = np.arange(n * n).reshape(n, n) / 100
    w = tiling.generate_windows(spark.createDataFrame([("c", 80)], "chrom string, chrom_size long"), 60, 20)
    data = [("c", k, "T 1", i, [float(v) for v in m[i]]) for k in range(2) for i in range(n)]
    r = spark.createDataFrame(data, "chrom string, window_idx long, track string, row_idx long, row array<double>")
    got = {(x["bin1_start"], x["bin2_start"], x["contact_freq"]) for x in contacts.contact_tokens(r, w, 10, 20, 0.05).collect()}
    expect = set()
    for k, (start, lo, hi) in enumerate([(0, 0, 20), (20, 60, 80)]):
        kept = [i for i in range(n) if lo <= start + 10 * i < hi]
        expect |= {(start + 10 * i, start + 10 * j, m[i, j]) for i in kept for j in kept if i <= j and m[i, j] >= 0.05}
    assert got == expect
    totals = {x["bin"]: round(x["total"], 9) for x in contacts.contact_row_totals(r, w, 10, 0.05).collect()}
    assert totals[2] == round(m[2][m[2] >= 0.05].sum() + m[0][m[0] >= 0.05].sum(), 9)


def test_thresholds_differ(spark):
    v = float(np.float32(1e-4))
    t = spark.createDataFrame([("e", "a", 0, "a", 10, v), ("e", "a", 0, "b", 10, 5.0), ("e", "b", 0, "a", 10, 5.0), ("e", "a", 10, "a", 10, float("nan"))], "accession string, chrom1 string, bin1 long, chrom2 string, bin2 long, counts float")
    chroms = spark.createDataFrame([("a", 0), ("b", 1)], "chrom string, ord int")
    assert contacts.sparse_contacts(t, 10, chroms, least=v).count() == 0  # strictly above
    both = t.where("chrom1 = chrom2 OR counts > 1").withColumn("bin2", F.when(F.col("chrom1") == "b", 70).otherwise(F.col("bin2")).cast("long"))
    assert rows(contacts.sparse_contacts(both, 10, chroms, True, v).select("chrom1", "start1", "chrom2", "start2"), "start1") == [("a", 0, "b", 10), ("a", 70, "b", 0)]
    assert rows(contacts.chrom_pairs(chroms), "chrom1") == [("a", "b")]


def test_catalogs(spark):
    c = spark.createDataFrame([("x", 5000), ("x", 25000), ("y", None)], "accession string, resolution int")
    assert rows(contacts.nearest_resolution(c, 15000), "accession") == [("x", 5000), ("y", 15000)]
    n = spark.createDataFrame([("x", "VC_SQRT"), ("x", "KR"), ("y", "other")], "accession string, norm string")
    assert rows(contacts.preferred_normalisation(n), "accession") == [("x", "KR"), ("y", "NONE")]


def test_narrow_peak(spark):
    lines = spark.createDataFrame([("track x",), ("",), ("# c",), ("chr1\t100\t201\tn\t5\t.\t1.5\t2\tx\t-1",), ("chr1\t100\t201\tn\t5\t.\t1.5\t2\t3\t7",), ("chr2\t1\t4",)], "value string")
    got = rows(experiments.summits(text.parse_narrow_peak(lines)).select("chrom", "start", "summit", "name", "peak_offset"), "chrom", "summit")
    assert got == [("chr1", 100, 107, "n", 7), ("chr1", 100, 150, "n", -1), ("chr2", 1, 2, "-1", -1)]


def test_names(spark):
    names = ["Histone ChIP-seq H3K27ac liver", "histone chip_seq odd name", "", "x h2afz y"]
    df = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "n string, k int")
    assert [r[0] for r in df.orderBy("k").select(N.histone_column("n", "k")).collect()] == ["h3k27ac", "odd_name", "histone_2", "h2afz"]
    f = spark.createDataFrame([("TF ChIP-seq CTCF", ""), ("x", " My TF "), ("ChIP-seq ", None)], "n string, t string")
    assert [r[0] for r in f.select(N.factor_column("n", "t", F.lit(4))).collect()] == ["ctcf", "_my_tf_", "tf_4"]
    u = spark.createDataFrame([("https://h/a/F.bed.gz?x=1",), ("https://h/a.b/F",), ("/x/F.bigWig",)], "u string")
    assert [r[0] for r in u.select(N.url_suffix("u")).collect()] == [".bed.gz", ".bin", ".bigWig"]
    one = spark.range(1)
    assert one.select(N.assay_slug(F.lit("TF-ChIP-seq"))).first()[0] == "tf_chip_seq"
    assert one.select(N.finite_or_null(F.lit(float("nan"))), N.finite_or_null(F.lit(1.5))).first()[:] == (None, 1.5)


def test_array_files(spark, tmp_path):
    x = np.arange(20, dtype=np.float32).reshape(10, 2)
    np.savez(tmp_path / "chr1.npz", values=x, resolution=np.int32(128), chrom="chr1", chrom_size=np.int64(1280))
    blocks = arrays.read_signal(spark, str(tmp_path / "chr1.npz"), 4)
    assert blocks.count() == 6
    got = rows(arrays.long_form(blocks, 4).where("track_idx = 1").select("bin", "value"), "bin")
    assert got == [(i, float(x[i, 1])) for i in range(10)]
    again = arrays.to_blocks(arrays.long_form(blocks, 4), 4)
    assert rows(again.select("track_idx", "block_idx", "values"), "track_idx", "block_idx") == rows(blocks.select("track_idx", "block_idx", "values"), "track_idx", "block_idx")
    (tmp_path / "m").mkdir()
    np.savez(tmp_path / "m" / "chr2_100_300.npz", values=np.ones((2, 2, 1), np.float32), resolution=np.int32(100), chrom="chr2", start=np.int64(100), end=np.int64(300), track_names=np.array(["a"]), track_strands=np.array(["."]))
    assert rows(arrays.read_contacts(spark, str(tmp_path / "m")).select("chrom", "start", "end", "row_idx", "row"), "row_idx") == [("chr2", 100, 300, 0, [1.0, 1.0]), ("chr2", 100, 300, 1, [1.0, 1.0])]


def test_sidecar_and_sinks(spark, tmp_path):
    (tmp_path / "s.json").write_text('[{"name": "b", "strand": "+"}, {"name": "a", "strand": ".", "transcription_factor": "CTCF"}]')
    got = rows(arrays.read_track_names(spark, str(tmp_path / "s.json")).select("track_idx", "name", "transcription_factor"), "track_idx")
    assert got == [(0, "b", None), (1, "a", "CTCF")]
    df = spark.createDataFrame([("t1", "c1", 1), ("t2", "c2", 2)], "token_id string, chrom string, x int")
    sinks.write_tokens(df, str(tmp_path / "out"))
    sinks.write_tokens(df.where("chrom = 'c2'").withColumn("x", F.lit(9)), str(tmp_path / "out"))
    assert rows(sinks.read_tokens(spark, str(tmp_path / "out")).select("token_id", "x"), "token_id") == [("t1", 1), ("t2", 9)]
    left = experiments.still_to_do(df, df.where("chrom = 'c1'"), ["chrom"])
    assert [r["token_id"] for r in left.collect()] == ["t2"]


def test_saved_search_pages(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"total": 2, "@graph": [{"accession": "E1", "assay_title": "TF ChIP-seq", "target": {"label": "CTCF"}, "biosample_ontology": {"term_name": "K"}, "files": ['
        '{"accession": "F1", "file_type": "bed narrowPeak", "status": "released", "assembly": "hg19", "output_type": "IDR thresholded peaks", "href": "/1"},'
        '{"accession": "F2", "file_type": "bed narrowPeak", "status": "released", "assembly": ["hg19", "GRCh38"], "output_type": "other", "href": "/2"},'
        '{"accession": "F3", "file_type": "bed narrowPeak", "status": "released", "assembly": [{"ncbi_version_name": "GRCh38"}], "output_type": "optimal IDR thresholded peaks", "href": "/3"},'
        '{"accession": "F4", "file_type": "hic", "status": "released", "assembly": "hg19", "output_type": "x", "href": "/4"}]},'
        '{"accession": "E2", "assay_title": "y", "target": "gone", "files": []}]}'
    )
    e = text.read_experiments(spark, str(tmp_path / "p.json"))
    got = rows(e.select("accession", "target", "biosample", experiments.best_peak_file(F.col("files"), "GRCh38")["href"], experiments.best_contact_file(F.col("files"), "GRCh38")["href"]), "accession")
    assert got == [("E1", "CTCF", "K", "/3", "/4"), ("E2", "", "", None, None)]


@pytest.mark.parametrize("block", [3, 7, 1000])
def test_local_maxima_in_blocks(spark, block):
    """Flat runs that cross blocks, or fill several of them, count once."""
    rng = np.random.default_rng(block)
    for x in ([0, 5, 5, 5, 5, 5, 5, 5, 0, 1], [1, 1, 1, 1, 1, 1, 1, 2, 2, 2, 2, 2, 2, 2, 2, 1], rng.integers(0, 3, 60).tolist(), [4], [1, 2], [0, 1, 0]):
        got = sorted(r["bin"] for r in peaks.local_maxima(signal(spark, x), block=block).collect())
        assert got == peaks._maxima(np.array(x, float)).tolist()


def test_summaries_without_areas(spark):
    t = spark.createDataFrame([("a", "E", "b", "t", "c", float("nan")), ("a", "F", "b", "t", "c", 2.0), ("a", "F", "b", "t", "d", float("nan"))], "assay string, experiment_accession string, biosample string, target string, chrom string, auc double")
    got = {r["experiment_accession"]: (r["n_tokens"], r["n_chroms"], r["median_auc"]) for r in experiments.summarise(t).collect()}
    assert got["F"] == (2, 2, 2.0) and got["E"][:2] == (1, 1) and np.isnan(got["E"][2])


def test_factor_names_as_given(spark):
    df = spark.createDataFrame([(" x y ", " P 1 "), ("TF ChIP-seq ChIP-seq  b c", ""), ("ChIP-seq ", None)], "name string, tf string")
    got = [r[0] for r in df.select(naming.factor_column("name", "tf")).collect()]
    assert got == ["_p_1_", "b_c", "tf_0"]


def test_outputs_and_windows(spark):
    assert pipelines.requested_outputs() == ["atac", "chip_histone", "chip_tf", "contact_maps"] and pipelines.requested_outputs(False)[-1] == "chip_tf"
    assert pipelines.stitchable("cage") == "cage"
    with pytest.raises(ValueError):
        pipelines.stitchable("contact_maps")
    w = spark.createDataFrame([("a", 0, 0, 100), ("a", 1, 50, 130), ("b", 0, 0, 30)], "chrom string, window_idx long, start long, end long")
    assert rows(tiling.model_windows(w, 100).select("chrom", "start", "model_start", "model_end"), "chrom", "start") == [("a", 0, 0, 100), ("a", 50, 40, 140), ("b", 0, 0, 30)]


def test_contact_writer_needs_rows(spark, tmp_path):
    none = spark.createDataFrame([], arrays.CONTACTS)
    with pytest.raises(ValueError):
        arrays.write_contacts(none, str(tmp_path / "m"))


def test_one_experiment_limit(spark):
    e = spark.createDataFrame([("x", "a", "K", 1), ("y", "a", "K", 0), ("z", "a", "H", 2)], "accession string, assay string, biosample string, place int")
    assert sorted(r["accession"] for r in portal.first_experiments(e, 1).collect()) == ["y", "z"]
    assert portal.first_experiments(e, None).count() == 3
