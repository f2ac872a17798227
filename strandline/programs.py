"""Named queries for the composed programs, sources and sinks, with their SQL twins."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strandline.functions import naming as N
from strandline.operators import blocks, classify, contacts, experiments, nearest, peaks, tiling
from strandline.plans import matrices, pipelines, portal
from strandline.registry import DAILY, FILES_SQL, MATRIX, ORDER_TRACKS, TRACKS, _daily, _matrix_rows, _nation_sizes, _nested_files, _order_tracks, hours, peaks_sql, query, smooth_sql, table, tracks
from strandline.sources import arrays, bigwig, files, hic, npz, sinks, text
from strandline.storage import new_path

# ---- peaks of tracks, from fine bins to named tokens ----

FINE = peaks_sql("tracks", 64, distance=4)


@query(f"WITH RECURSIVE {TRACKS}, {FINE}")
def fine_peaks(spark, sf_dir):
    """Bins of 64 base pairs: peaks suppress others within four bins, also across blocks."""
    found = peaks.call_peaks(tracks(spark, sf_dir), 64, block=64)
    return found.select("track", "start", "end", "summit", F.round("auc", 4).alias("auc"), "signal_value", F.round("prominence", 6).alias("prominence"))


POOLED = """pool AS (SELECT track, bin // 4 AS bin, sum(value) / 4 AS value FROM tracks WHERE bin < (SELECT n - n % 4 FROM hours) GROUP BY 1, 2)"""


@query(f"""WITH RECURSIVE {TRACKS}, {POOLED}, {smooth_sql("pool", "psmooth", 14)}, tok AS (SELECT * FROM (WITH {peaks_sql("psmooth", 128)}))
SELECT 'atac:ATAC ' || track || ':month:' || start || ':' || "end" AS token_id, 'month' AS chrom, start, "end", summit, round(auc, 2) AS auc, round(signal_value, 4) AS signal_value, round(prominence, 4) AS prominence, 'ATAC ' || track AS track_name, 'atac' AS assay FROM tok""")
def peak_tokens(spark, sf_dir):
    signal = tracks(spark, sf_dir)
    names = signal.select("track").distinct().withColumn("track_name", F.concat(F.lit("ATAC "), "track"))
    sizes = hours(spark, sf_dir).select("chrom", (F.col("n_bins") * 32).alias("chrom_size"))
    out = pipelines.peak_tokens(signal, names, sizes, "atac", 32, 128)
    return out.withColumns({c: F.round(c, d) for c, d in (("auc", 2), ("signal_value", 4), ("prominence", 4))})


# ---- elements: orders as peaks on days, flags as chromosomes ----

ELEMENTS = f"""{DAILY}, s AS (SELECT chrom, CASE track WHEN 'O' THEN 'h3k4me3' ELSE 'h3k27ac' END AS name, day, q FROM d UNION ALL SELECT chrom, 'ctcf', day, CAST(sum(q) AS BIGINT) FROM d GROUP BY 1, 3),
p AS (SELECT o_orderkey AS k, (['A', 'N', 'R', 'Z'])[o_orderkey % 4 + 1] AS chrom, (o_orderkey * 7) % 300 AS a, (o_orderkey * 7) % 300 + o_custkey % 5 + 1 AS b, (o_orderkey * 7) % 300 + o_custkey % 5 AS m, o_custkey % 100 AS auc FROM orders),
u AS (SELECT DISTINCT chrom, a, b FROM p),
mean AS (SELECT u.chrom, a, b, coalesce(avg(q) FILTER (WHERE name = 'h3k4me3'), 0) AS x, coalesce(avg(q) FILTER (WHERE name = 'h3k27ac'), 0) AS y, coalesce(avg(q) FILTER (WHERE name = 'ctcf'), 0) AS t
  FROM u LEFT JOIN s ON s.chrom = u.chrom AND day >= a AND day < b GROUP BY 1, 2, 3),
z AS (SELECT p.*, x, y, t, {", ".join(f"CASE WHEN stddev_pop({c}) OVER w < 1e-9 THEN 0 ELSE ({c} - avg({c}) OVER w) / stddev_pop({c}) OVER w END AS z{c}" for c in "xyt")}
  FROM p JOIN mean USING (chrom, a, b) WINDOW w AS (PARTITION BY chrom)),
g AS (SELECT (['A', 'N', 'R'])[p_partkey % 3 + 1] AS chrom, (p_partkey * 31) % 400 AS pos, p_partkey AS ord FROM part),
c AS (SELECT v.chrom, m, abs(pos - m) AS dist, ord, row_number() OVER (PARTITION BY v.chrom, m ORDER BY abs(pos - m), CASE WHEN pos < m THEN 0 ELSE 1 END, CASE WHEN pos < m THEN -ord ELSE ord END) AS n
  FROM (SELECT DISTINCT chrom, m FROM p) v JOIN g ON g.chrom = v.chrom),
e AS (SELECT z.*, coalesce(dist, -1) AS dist, coalesce('g' || ord, '') AS gene FROM z LEFT JOIN c ON c.chrom = z.chrom AND c.m = z.m AND c.n = 1)"""
_HIGH = {c: f"CAST(z{c} AS FLOAT) >= CAST(1.64 AS FLOAT)" for c in "xyt"}


@query(f"""WITH {ELEMENTS} SELECT 'ccre:' || chrom || ':' || a || ':' || b AS token_id, chrom, a AS start, b AS "end", m AS summit, auc, CAST(0 AS DOUBLE) AS atac_signal,
CASE WHEN {_HIGH["x"]} AND dist <= 200 THEN 'PLS' WHEN {_HIGH["x"]} THEN 'DNase-H3K4me3' WHEN {_HIGH["y"]} AND dist <= 2000 THEN 'pELS' WHEN {_HIGH["y"]} THEN 'dELS' WHEN {_HIGH["t"]} THEN 'CTCF-only' ELSE 'low-DNase' END AS ccre_class,
dist AS tss_distance, gene AS nearest_gene, round(zx, 6) AS h3k4me3_z, round(zy, 6) AS h3k27ac_z, round(zt, 6) AS ctcf_z, round(x, 6) AS h3k4me3, round(y, 6) AS h3k27ac, round(t, 6) AS ctcf FROM e""")
def element_tokens(spark, sf_dir):
    """Many orders share their ends: each is one element."""
    out = _elements(spark, sf_dir)
    rounded = {c: F.round(c, 6) for c in ("h3k4me3_z", "h3k27ac_z", "ctcf_z", "h3k4me3", "h3k27ac", "ctcf")}
    return out.withColumns(rounded).withColumn("auc", F.col("auc").cast("long")).withColumn("atac_signal", F.col("atac_signal").cast("double")).drop("signal_value")


@query(f"""WITH {ELEMENTS}, y AS (SELECT chrom, day, CAST(sum(q) AS BIGINT) + 1 AS v FROM d GROUP BY 1, 2),
w AS (SELECT u.chrom, a, b, CAST(coalesce(sum(v), 0) AS DOUBLE) / (b - a) AS atac FROM u LEFT JOIN y ON y.chrom = u.chrom AND day >= a AND day < b GROUP BY 1, 2, 3)
SELECT 'ccre:' || e.chrom || ':' || e.a || ':' || e.b AS token_id, m AS summit, round(CAST(CAST(atac AS FLOAT) AS DOUBLE), 3) AS atac_signal, dist AS tss_distance FROM e JOIN w ON w.chrom = e.chrom AND w.a = e.a AND w.b = e.b""")
def element_tokens_atac(spark, sf_dir):
    """With the mean of a signal by base over each element, kept as blocks of 32 days in which a day without a value is 0."""
    daily = _daily(spark, sf_dir).groupBy("chrom", "day").agg((F.sum("q") + 1).cast("double").alias("value"))
    known = daily.groupBy("chrom", F.floor(F.col("day") / 32).alias("block_idx")).agg(F.map_from_entries(F.collect_list(F.struct((F.col("day") % 32).cast("int"), "value"))).alias("v"))
    values = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: F.coalesce(F.try_element_at("v", k), F.lit(0.0)))
    out = _elements(spark, sf_dir, known.select("chrom", "block_idx", values.alias("values")))
    return out.select("token_id", "summit", F.round(F.col("atac_signal").cast("double"), 3).alias("atac_signal"), "tss_distance")


def _elements(spark, sf_dir, atac=None):
    daily = _daily(spark, sf_dir)
    name = F.when(F.col("track") == "O", "h3k4me3").otherwise("h3k27ac")
    both = daily.groupBy("chrom", "day").agg(F.sum("q").alias("q")).select("chrom", F.lit("ctcf").alias("name"), "day", "q")
    signal = daily.select("chrom", name.alias("name"), "day", "q").unionByName(both).select("chrom", "name", F.col("day").alias("bin"), F.col("q").alias("value"))
    o = table(spark, sf_dir, "orders")
    chrom = F.element_at(F.array(*map(F.lit, "ANRZ")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    start = (F.col("o_orderkey") * 7) % 300
    found = o.select(chrom.alias("chrom"), start.alias("start"), (start + F.col("o_custkey") % 5 + 1).alias("end"), (start + F.col("o_custkey") % 5).alias("summit"), (F.col("o_custkey") % 100).alias("auc"))
    p = table(spark, sf_dir, "part")
    at = F.element_at(F.array(*map(F.lit, "ANR")), (F.col("p_partkey") % 3 + 1).cast("int"))
    tss = p.select(at.alias("chrom"), ((F.col("p_partkey") * 31) % 400).alias("pos"), F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("name"), F.col("p_partkey").alias("ord"))
    return pipelines.element_tokens(found, signal, tss, 1, ["h3k4me3", "h3k27ac", "ctcf"], atac, 32)


@query(f"""WITH {ELEMENTS} SELECT CASE WHEN {_HIGH["x"]} AND dist <= 200 THEN 'PLS' WHEN {_HIGH["x"]} THEN 'DNase-H3K4me3' WHEN {_HIGH["y"]} AND dist <= 2000 THEN 'pELS' WHEN {_HIGH["y"]} THEN 'dELS' WHEN {_HIGH["t"]} THEN 'CTCF-only' ELSE 'low-DNase' END AS ccre_class,
count(*) AS n FROM e GROUP BY 1""")
def class_histogram(spark, sf_dir):
    return classify.class_counts(_elements(spark, sf_dir))


# ---- feature matrices and contact windows ----

_MARKS = ["Histone ChIP-seq K562 H3K27ac", "H3K4me3 of K562", "histone chip_seq h3k27ac", "K562 H3K27AC z", "Other mark"]
_FACTORS = [("TF ChIP-seq CTCF", ""), ("x", "POL II"), ("ChIP-seq other", ""), ("TF ChIP-seq ChIP-seq ctcf", ""), ("atac", "")]
_FEATURES = {"atac": "v4", "h3k27ac": "((v0 + v2) / 2 + v3) / 2", "h3k4me3": "v1", "other_mark": "v4", "ctcf": "(v0 + v3) / 2", "pol_ii": "v1", "other": "v2"}
_EVENTS = ("click", "error", "purchase", "signup", "view")


def _tracks_by_number(spark, sf_dir):
    return tracks(spark, sf_dir).select("chrom", (F.array_position(F.array(*map(F.lit, _EVENTS)), F.col("track")) - 1).cast("int").alias("track_idx"), "bin", "value")


@query(f"""WITH {TRACKS}, v AS (SELECT bin // 7 AS i, {", ".join(f"sum(value) FILTER (WHERE track = '{t}') / 7 AS v{k}" for k, t in enumerate(_EVENTS))} FROM tracks WHERE bin < (SELECT n - n % 7 FROM hours) GROUP BY 1),
g AS (SELECT unnest(range(CAST(ceil(n / 7.0) AS BIGINT))) AS i, n FROM hours), f AS (SELECT g.i, n, {", ".join(f"coalesce(v{k}, 0) AS v{k}" for k in range(5))} FROM g LEFT JOIN v USING (i))
SELECT i * 7 AS start, least(i * 7 + 7, n) AS "end", {", ".join(f"round(CAST(CAST({x} AS FLOAT) AS DOUBLE), 3) AS {c}" for c, x in _FEATURES.items())} FROM f""")
def fixed_bin_program(spark, sf_dir):
    """Three assays at one resolution; the last track of the third is called like the first assay, so it takes its column's place."""
    signal = _tracks_by_number(spark, sf_dir)
    numbers = signal.select("track_idx").distinct()
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("track_idx") + 1)
    marks = numbers.select("track_idx", pick(_MARKS).alias("name"), F.lit(None).cast("string").alias("transcription_factor"))
    factors = numbers.select("track_idx", pick([n for n, _ in _FACTORS]).alias("name"), pick([f for _, f in _FACTORS]).alias("transcription_factor"))
    assays = {"atac": (signal.where("track_idx < 2"), marks.where("track_idx < 2"), 1), "chip_histone": (signal, marks, 1), "chip_tf": (signal, factors, 1)}
    out = matrices.fixed_bin_tokens(assays, hours(spark, sf_dir).select("chrom", "chrom_size"), 7).drop("chrom")
    return out.select("start", "end", *(F.round(F.col(c).cast("double"), 3).alias(c) for c in out.columns[2:]))


@query(f"""WITH {MATRIX}, t AS (SELECT i, sum(CASE WHEN CAST(f AS FLOAT) >= CAST(0.0001 AS FLOAT) THEN CAST(CAST(f AS FLOAT) AS DOUBLE) ELSE 0 END) AS total FROM cell GROUP BY 1)
SELECT e.i * 2048 AS start, e.i * 2048 + 2048 AS "end", round(CAST(CAST(list_sum(e.x) AS FLOAT) AS DOUBLE), 4) AS atac, round(CAST(CAST(total AS FLOAT) AS DOUBLE), 4) AS contact_total FROM e JOIN t ON t.i = e.i""")
def fixed_bin_contacts(spark, sf_dir):
    rows, windows = _matrix_rows(spark, sf_dir)
    e = table(spark, sf_dir, "embeddings")
    signal = e.select(F.lit("v").alias("chrom"), F.lit(0).alias("track_idx"), F.col("vec_id").alias("bin"), F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x).alias("value"))
    names = spark.createDataFrame([(0, "a", None)], "track_idx int, name string, transcription_factor string")
    wide = windows.select("chrom", "window_idx", (F.col("start") * 2048).alias("start"), (F.col("chrom_size") * 2048).alias("chrom_size"))
    sizes = wide.select("chrom", "chrom_size").distinct()
    floats = rows.withColumn("row", F.col("row").cast("array<float>"))
    out = matrices.fixed_bin_tokens({"atac": (signal, names, 2048)}, sizes, 2048, ["atac", "contact_total"], (floats, wide))
    return out.select("start", "end", F.round(F.col("atac").cast("double"), 4).alias("atac"), F.round(F.col("contact_total").cast("double"), 4).alias("contact_total"))


CUT = f"""{MATRIX}, f AS (SELECT DISTINCT k, a, CASE WHEN k % 3 = 1 THEN least(b, a + 12) ELSE b END AS b, n FROM r),
y AS (SELECT *, CASE WHEN n = 1 OR k = 0 THEN a WHEN k = n - 1 THEN greatest(b - 16, a) ELSE a + CAST(floor((b - a - 16) / 2.0) AS BIGINT) END AS x0,
  CASE WHEN n = 1 OR k = n - 1 THEN b WHEN k = 0 THEN least(a + 16, b) ELSE a + CAST(floor((b - a - 16) / 2.0) AS BIGINT) + 16 END AS x1 FROM f),
cc AS (SELECT y.*, c.i, c.j, c.f FROM y JOIN cell c ON c.k = y.k AND c.i < y.b AND c.j < y.b)"""


@query(f"""WITH {CUT} SELECT 'contact:t:v:' || i || ':' || j AS token_id, 'v' AS chrom, i AS bin1_start, i + 1 AS bin1_end, j AS bin2_start, j + 1 AS bin2_end, f AS contact_freq, 't' AS track_name, 1 AS resolution
FROM cc WHERE i >= x0 AND i < x1 AND j >= x0 AND j < x1 AND i <= j AND f >= 0.001""")
def contact_window_tokens(spark, sf_dir):
    """Windows known by their ends alone, every third one cut short."""
    rows, windows = _matrix_rows(spark, sf_dir)
    ends = windows.select("window_idx", "start", F.when(F.col("window_idx") % 3 == 1, F.least(F.col("end"), F.col("start") + 12)).otherwise(F.col("end")).alias("end"))
    n = (F.col("end") - F.col("start")).cast("int")
    files = rows.join(ends, "window_idx").where(F.col("row_idx") < n).select("chrom", "start", "end", F.col("track").alias("track_name"), "row_idx", F.slice("row", F.lit(1), n).alias("row"))
    return matrices.contact_window_tokens(files, 1, 16, 1e-3)


@query(f"""WITH {MATRIX} SELECT k AS window_idx, i - a AS row_idx, CAST(CAST(arg_min(f, j) AS FLOAT) AS DOUBLE) AS first_value, CAST(CAST(arg_max(f, j) AS FLOAT) AS DOUBLE) AS last_value, count(*) AS n FROM cell GROUP BY k, i, a""")
def contact_files(spark, sf_dir):
    """Contact windows packed as array files by tasks, and read back from their bytes."""
    rows, windows = _matrix_rows(spark, sf_dir)

    def pack(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("row_idx")
        start, end = t.column("start")[0].as_py(), t.column("end")[0].as_py()
        out = io.BytesIO()
        values = np.array(t.column("row").to_pylist(), np.float32)[:, :, None]
        np.savez_compressed(out, values=values, resolution=np.int32(1), chrom=np.array("v"), start=np.int64(start), end=np.int64(end), track_names=np.array(["t"]), track_strands=np.array(["."]))
        return pa.table({"path": [f"/maps/v_{start}_{end}.npz"], "content": pa.array([out.getvalue()], pa.binary())})

    at = rows.join(windows.select("window_idx", "start", "end"), "window_idx").select("window_idx", "row_idx", "row", "start", "end")
    files = at.groupBy("window_idx").applyInArrow(pack, "path string, content binary")
    back = arrays.decode_contacts(files)
    numbered = back.join(contacts.window_numbers(back).select("chrom", "start", "end", "window_idx"), ["chrom", "start", "end"])
    return numbered.select("window_idx", "row_idx", F.element_at("row", 1).cast("double").alias("first_value"), F.element_at("row", -1).cast("double").alias("last_value"), F.size("row").cast("long").alias("n"))


@query(f"WITH {TRACKS} SELECT track, 'tr ' || track AS name, bin, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM tracks")
def track_files(spark, sf_dir):
    """Each track packed as an array file, its description as a list beside it, and both read back from their bytes."""

    def pack(key: tuple, t: pa.Table) -> pa.Table:
        t, out = t.sort_by("bin"), io.BytesIO()
        values = t.column("value").to_numpy().astype(np.float32)
        np.savez_compressed(out, values=values, resolution=np.int32(1), chrom=np.array(key[0].as_py()), chrom_size=np.int64(len(values)))
        return pa.table({"path": [f"/tracks/{key[0].as_py()}.npz"], "content": pa.array([out.getvalue()], pa.binary())})

    files_ = tracks(spark, sf_dir).groupBy("track").applyInArrow(pack, "path string, content binary")
    signal = arrays.decode_signal(files_, 100)
    listed = tracks(spark, sf_dir).select("track").distinct().select(F.concat(F.lit("/tracks/"), "track", F.lit(".json")).alias("file"), F.to_json(F.array(F.struct(F.concat(F.lit("tr "), "track").alias("name"), F.lit(".").alias("strand")))).alias("value"))
    names = arrays.parse_track_names(listed).select(F.regexp_extract("file", r"([^/]+)\.json$", 1).alias("chrom"), "track_idx", "name")
    long = arrays.long_form(signal, 100).join(names, ["chrom", "track_idx"])
    return long.select(F.col("chrom").alias("track"), "name", "bin", F.col("value").cast("double").alias("value"))


@query(f"WITH {TRACKS} SELECT track, bin, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM tracks")
def track_archives(spark, sf_dir):
    """A file for each track, written block by block with a commit at the end, and read back in ranges of rows."""
    path, signal = new_path(spark, "archives"), tracks(spark, sf_dir)
    n = hours(spark, sf_dir).select(F.lit(1).alias("one"), "n_bins")
    dense = blocks.from_rows(signal.withColumn("one", F.lit(1)), ("one", "track"), 100, n)
    rows = dense.join(n, "one").select(F.lit("events").alias("assay"), F.col("track").alias("chrom"), F.col("n_bins").alias("chrom_size"), F.lit(1).alias("resolution"), F.lit(0).alias("track_idx"), "block_idx", "values")
    npz.write_tracks(rows, path)
    back = arrays.long_form(npz.read_tracks(spark, path, 64, 400), 64)
    return back.select(F.col("chrom").alias("track"), "bin", F.col("value").cast("double").alias("value"))


@query(f"""WITH {DAILY} SELECT chrom AS accession, track AS chrom, day AS start, day + 1 AS "end", CAST(q AS DOUBLE) AS value FROM d WHERE track = 'O' OR day BETWEEN 100 AND 299""")
def bigwig_ranges(spark, sf_dir):
    """A binary file for each return flag, written by tasks; of one chromosome all is read, of the other a range."""
    path = new_path(spark, "bigwig")
    daily = _daily(spark, sf_dir).where("day >= 0")

    def pack(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by([("track", "ascending"), ("day", "ascending")])
        rows = [(c, d, d + 1, float(q)) for c, d, q in zip(*(t.column(c).to_pylist() for c in ("track", "day", "q")))]
        system, at = files.located(f"{path}/{key[0].as_py()}.bw")
        system.create_dir(at.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(at) as out:
            out.write(bigwig.encode([("F", 10_000), ("O", 10_000)], rows))
        return pa.table({"rows": [len(rows)]})

    daily.groupBy("chrom").applyInArrow(pack, "rows long").count()
    parts = bigwig.read_bigwig(spark, path, "O", part_bytes=2000).unionByName(bigwig.read_bigwig(spark, path, "F", 100, 300, 2000))
    return parts.select("accession", "chrom", "start", "end", F.col("value").cast("double").alias("value"))


@query("""SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS token_id, 'c' || l_suppkey % 5 AS chrom, l_partkey AS start FROM lineitem""")
def resumed_tokens(spark, sf_dir):
    """Two chromosomes are done, a third is left half written by a run that was killed: the next run writes what is missing, each partition once."""
    line, path = table(spark, sf_dir, "lineitem"), new_path(spark, "resumed")
    tokens = line.select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("token_id"), F.concat(F.lit("c"), (F.col("l_suppkey") % 5).cast("string")).alias("chrom"), F.col("l_partkey").alias("start"))
    sinks.write_missing(tokens.where("chrom IN ('c0', 'c1')"), path)
    tokens.where("chrom = 'c2' AND start % 2 = 0").write.mode("append").partitionBy("chrom").parquet(f"{path}/data")
    sinks.write_missing(tokens, path)
    return sinks.read_committed(spark, path, ("chrom",), tokens)


@query(f"WITH {TRACKS} SELECT track, bin // 100 AS block_idx, count(*) AS n, round(sum(CAST(value AS FLOAT)), 3) AS total FROM tracks GROUP BY 1, 2")
def track_blocks(spark, sf_dir):
    """Tracks written as blocks by assay and chromosome, and read back."""
    path = new_path(spark, "blocks")
    arrays.write_signal(_tracks_by_number(spark, sf_dir).withColumn("assay", F.lit("atac")), path, 100)
    total = F.aggregate("values", F.lit(0.0), lambda a, v: a + v)
    back = spark.read.parquet(path).where("assay = 'atac' AND chrom = 'month'")
    return back.select(F.element_at(F.array(*map(F.lit, _EVENTS)), F.col("track_idx") + 1).alias("track"), "block_idx", F.size("values").cast("long").alias("n"), F.round(total, 3).alias("total"))


@query(f"""WITH {MATRIX} SELECT k AS window_idx, count(DISTINCT i) AS n_rows, round(sum(CAST(f AS FLOAT)), 3) AS total FROM cell GROUP BY 1""")
def contact_blocks(spark, sf_dir):
    path = new_path(spark, "maps")
    rows, windows = _matrix_rows(spark, sf_dir)
    arrays.write_contacts(rows.join(windows.select("window_idx", "start", "end"), "window_idx").select("chrom", "start", "end", F.lit(1).alias("resolution"), F.col("track").alias("track_name"), "row_idx", "row"), path)
    back = spark.read.parquet(path).where("chrom = 'v'")
    total = F.aggregate("row", F.lit(0.0), lambda a, v: a + v)
    return back.groupBy((F.col("start") / 16).cast("long").alias("window_idx")).agg(F.count("*").alias("n_rows"), F.round(F.sum(total), 3).alias("total"))


# ---- predictions in windows ----

NATIONS = """s AS (SELECT n_name AS chrom, CAST(sum(CAST(floor(abs(c_acctbal)) AS BIGINT)) AS BIGINT) AS size FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
m AS (SELECT *, CASE WHEN size <= 20000 THEN 1 ELSE CAST(ceil((size - 20000) / 10000.0) AS BIGINT) + 1 END AS n FROM s),
i AS (SELECT *, unnest(range(n)) AS k FROM m), w AS (SELECT *, k * 10000 AS a, least(k * 10000 + 20000, size) AS b FROM i),
y AS (SELECT *, CASE WHEN n = 1 OR k = 0 THEN a WHEN k = n - 1 THEN greatest(b - 10000, a) ELSE a + (b - a - 10000) // 2 END AS x0, CASE WHEN n = 1 OR k = n - 1 THEN b WHEN k = 0 THEN least(a + 10000, b) ELSE a + (b - a - 10000) // 2 + 10000 END AS x1 FROM w),
l AS (SELECT *, (x0 - a) // 1000 AS lo, CAST(ceil((least(x1, b) - a) / 1000.0) AS BIGINT) AS hi FROM y),
v AS (SELECT *, unnest(range(lo, hi)) AS lb FROM l WHERE chrom != 'CHINA')"""


def _predictor(batches):
    """Stands for a model: 20 bins a window, whose values tell the window and the bin."""
    for b in batches:
        n = b.num_rows
        bins = np.tile(np.arange(20), n)
        idx = np.repeat(b.column("window_idx").to_numpy(), 20)
        chrom = b.column("chrom").take(pa.array(np.repeat(np.arange(n), 20)))
        yield pa.RecordBatch.from_arrays([chrom, pa.array(idx), pa.array(["t"] * len(bins)), pa.array(bins), pa.array((idx * 100 + bins).astype(np.float64))], names=["chrom", "window_idx", "track", "local_bin", "value"])


PREDICTED = "chrom string, window_idx long, track string, local_bin long, value double"


@query(f"WITH {NATIONS} SELECT chrom, 't' AS track, (a + lo * 1000) // 1000 + lb - lo AS bin, CAST(arg_max(k * 100 + lb, k) AS DOUBLE) AS value FROM v WHERE (a + lo * 1000) // 1000 + lb - lo < ceil(size / 1000.0) GROUP BY 1, 3")
def predict_tracks(spark, sf_dir):
    """Tile, predict, stitch, but for a chromosome that is done."""
    done = table(spark, sf_dir, "nation").where("n_name = 'CHINA'").select(F.col("n_name").alias("chrom"))
    return pipelines.predict_tracks(_nation_sizes(spark, sf_dir), _predictor, PREDICTED, 1000, 20000, 10000, done=done)


@query(f"WITH {NATIONS.replace(" WHERE chrom != 'CHINA'", "")} SELECT chrom, (a + lo * 1000) // 1000 + lb - lo AS bin, count(*) AS n_windows FROM v WHERE (a + lo * 1000) // 1000 + lb - lo < ceil(size / 1000.0) GROUP BY 1, 2")
def window_coverage(spark, sf_dir):
    windows = tiling.generate_windows(_nation_sizes(spark, sf_dir), 20000, 10000)
    return tiling.coverage(windows.mapInArrow(_predictor, PREDICTED), windows, 1000, 10000)


@query(f"""WITH {NATIONS} SELECT chrom, k AS window_idx, a AS start, b AS "end", CASE WHEN b - a != 20000 AND (a + b) // 2 >= 10000 THEN (a + b) // 2 - 10000 ELSE a END AS model_start,
CASE WHEN b - a != 20000 AND (a + b) // 2 >= 10000 THEN (a + b) // 2 + 10000 ELSE b END AS model_end FROM w""")
def model_windows(spark, sf_dir):
    windows = tiling.generate_windows(_nation_sizes(spark, sf_dir), 20000, 10000)
    return tiling.model_windows(windows, 20000).select("chrom", "window_idx", "start", "end", "model_start", "model_end")


@query("SELECT a.n_name AS chrom1, b.n_name AS chrom2 FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey")
def chrom_pairs(spark, sf_dir):
    return contacts.chrom_pairs(table(spark, sf_dir, "nation").select(F.col("n_name").alias("chrom"), F.col("n_nationkey").alias("ord")))


# ---- experiments: files, peaks, contacts, merge ----


def _pages(spark, sf_dir):
    """Orders as search pages in JSON, a page an order, with lines as files."""
    e = _nested_files(spark, sf_dir)
    assembly = lambda f: F.coalesce(F.to_json(f["assemblies"]), f["assembly"])
    file = lambda f: F.concat(
        F.lit('{"accession": "F'), f["href"], F.lit('", "file_type": "'), f["file_type"], F.lit('", "status": "'), f["status"], F.lit('", "output_type": "'), f["output_type"], F.lit('", "href": "'), f["href"],
        F.lit('", "assembly": '), F.when(f["assemblies"].isNotNull(), assembly(f)).otherwise(F.concat(F.lit('"'), assembly(f), F.lit('"'))), F.lit("}"),
    )
    key = F.col("accession").cast("string")
    target = F.when(F.col("accession") % 3 == 0, F.concat(F.lit('{"gene_name": "G'), key, F.lit('", "label": "L"}'))).when(F.col("accession") % 3 == 1, F.lit('{"label": "L"}')).otherwise(F.lit('"gone"'))
    term = F.when(F.col("accession") % 2 == 0, F.lit(', "biosample_ontology": {"term_name": "K562"}')).otherwise(F.lit(""))
    page = F.concat(F.lit('{"total": 1, "@graph": [{"accession": "E'), key, F.lit('", "assay_title": "TF ChIP-seq", "target": '), target, term, F.lit(', "files": ['), F.concat_ws(", ", F.transform("files", file)), F.lit("]}]}"))
    return e.select(page.alias("value"))


@query(f"""WITH {FILES_SQL} SELECT 'E' || k AS accession, 'TF ChIP-seq' AS assay, CASE k % 3 WHEN 0 THEN 'G' || k WHEN 1 THEN 'L' ELSE '' END AS target, CASE WHEN k % 2 = 0 THEN 'K562' ELSE '' END AS biosample,
max(CASE WHEN peak THEN 'https://p.example/f/' || l_linenumber END) AS peak_url, max(CASE WHEN peak THEN 'F/f/' || l_linenumber END) AS peak_accession, max(CASE WHEN peak THEN output END) AS peak_output_type,
max(CASE WHEN NOT peak THEN 'https://p.example/f/' || l_linenumber END) AS signal_url, coalesce(max(CASE WHEN NOT peak THEN 'F/f/' || l_linenumber END), '') AS signal_accession FROM r WHERE n = 1 GROUP BY k HAVING peak_url IS NOT NULL""")
def portal_peak_files(spark, sf_dir):
    return portal.peak_files(text.parse_experiments(_pages(spark, sf_dir)), "GRCh38", "https://p.example")


@query("""WITH f AS (SELECT l_orderkey AS k, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_suppkey % 3 > 0 OR l_suppkey % 2 = 0 THEN 0 ELSE 1 END, l_linenumber, l_partkey, l_suppkey) AS n
  FROM lineitem WHERE l_returnflag != 'R' AND l_linestatus = 'O') SELECT k AS accession, 'b' || k % 4 AS biosample, 'https://p.example/f/' || l_linenumber AS hic_url, '' AS hic_accession FROM f WHERE n = 1""")
def portal_contact_files(spark, sf_dir):
    """Files of contact lists: one of the assembly first, else any."""
    e = _nested_files(spark, sf_dir)
    hic = F.transform("files", lambda f: f.withField("file_type", F.when(f["file_type"] == "bigWig", "bigWig").otherwise("hic")).withField("accession", F.lit(None).cast("string")))
    return portal.contact_files(e.select("accession", F.concat(F.lit("b"), (F.col("accession") % 4).cast("string")).alias("biosample"), hic.alias("files")), "GRCh38", "https://p.example")


@query("""SELECT o_orderkey AS accession, CASE WHEN o_custkey % 3 != 0 THEN '/raw/p' || o_custkey END AS peak_path, CASE WHEN o_custkey % 5 = 0 THEN '/raw/s' || o_custkey END AS signal_path,
'/data/raw/tf_chip_seq/' || o_orderkey || '/F' || o_custkey || '.bed.gz' AS local FROM orders""")
def attach_paths(spark, sf_dir):
    o, key = table(spark, sf_dir, "orders"), F.col("o_custkey").cast("string")
    got = o.where("o_custkey % 3 != 0").select(F.col("o_orderkey").alias("accession"), F.lit("peak").alias("role"), F.concat(F.lit("/raw/p"), key).alias("path"))
    got = got.unionByName(o.where("o_custkey % 5 = 0").select(F.col("o_orderkey").alias("accession"), F.lit("signal").alias("role"), F.concat(F.lit("/raw/s"), key).alias("path")))
    local = N.local_path("/data", F.lit("TF-ChIP-seq"), F.col("o_orderkey").cast("string"), F.concat(F.lit("F"), key), F.concat(F.lit("https://p.example/x/"), key, F.lit(".bed.gz?v=1.2")))
    return portal.attach_paths(o.select(F.col("o_orderkey").alias("accession"), local.alias("local")), got).select("accession", "peak_path", "signal_path", "local")


AREAS = f"""g AS (SELECT 'E' || l_suppkey % 40 AS accession, 'c' || l_partkey % 3 AS chrom, CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS day, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem GROUP BY 1, 2, 3),
p AS (SELECT o_orderkey, o_custkey % 40 AS id, 'E' || o_custkey % 40 AS accession, 'c' || o_orderkey % 4 AS chrom, (o_orderkey * 7) % 900 AS a, (o_orderkey * 7) % 900 + o_custkey % 60 + 1 AS b, o_custkey % 10 AS v, o_orderkey % 5 - 1 AS off FROM orders),
u AS (SELECT DISTINCT accession, chrom, a, b FROM p),
m AS (SELECT u.accession, u.chrom, a, b, coalesce(CAST(sum(q) AS DOUBLE) / count(q), 0) * (b - a) AS auc FROM u LEFT JOIN g ON g.accession = u.accession AND g.chrom = u.chrom AND day >= a AND day < b GROUP BY 1, 2, 3, 4),
t AS (SELECT p.*, CASE WHEN id < 30 THEN auc END AS auc FROM p JOIN m USING (accession, chrom, a, b) WHERE id < 35)"""


def _experiment_peaks(spark, sf_dir):
    line, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    name = lambda c, p: F.concat(F.lit(p), c.cast("string"))
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date")).cast("long")
    g = line.groupBy(name(F.col("l_suppkey") % 40, "E").alias("accession"), name(F.col("l_partkey") % 3, "c").alias("chrom"), day.alias("start")).agg(F.sum(F.col("l_quantity").cast("long")).cast("double").alias("value"))
    segments = g.withColumn("end", F.col("start") + 1)
    start = (F.col("o_orderkey") * 7) % 900
    found = o.select(
        name(F.col("o_custkey") % 40, "E").alias("accession"), name(F.col("o_orderkey") % 4, "c").alias("chrom"), start.alias("start"), (start + F.col("o_custkey") % 60 + 1).alias("end"), F.lit("n").alias("name"), F.lit(".").alias("strand"),
        (F.col("o_custkey") % 10).cast("double").alias("signal_value"), F.lit(1.0).alias("p_value"), F.lit(2.0).alias("q_value"), (F.col("o_orderkey") % 5 - 1).alias("peak_offset"),
    )
    ids = o.select((F.col("o_custkey") % 40).alias("id")).distinct().where("id < 35")
    info = ids.select(name(F.col("id"), "E").alias("accession"), name(F.col("id") % 3, "t").alias("target"), name(F.col("id") % 2, "b").alias("biosample"), F.lit("TF ChIP-seq").alias("assay"), (F.col("id") < 30).alias("has_signal"))
    return pipelines.experiment_peaks(found, segments, info, 64)


@query(f"""WITH {AREAS} SELECT 'tf_chip_seq:' || accession || ':' || chrom || ':' || a || ':' || b AS token_id, chrom, a AS start, b AS "end", CASE WHEN off >= 0 THEN a + off ELSE (a + b) // 2 END AS summit, coalesce(round(auc, 4), -1) AS auc,
CAST(v AS DOUBLE) AS signal_value, CAST(1 AS DOUBLE) AS p_value, CAST(2 AS DOUBLE) AS q_value, '.' AS strand, accession AS experiment_accession, 't' || id % 3 AS target, 'b' || id % 2 AS biosample, 'TF ChIP-seq' AS assay FROM t""")
def experiment_peaks(spark, sf_dir):
    """A chromosome that a signal lacks has area 0, an experiment without a signal NaN (here -1); equal peaks stay apart."""
    return _experiment_peaks(spark, sf_dir).withColumn("auc", F.round(F.nanvl("auc", F.lit(-1.0)), 4))


_NORM = "CASE WHEN k % 3 = 0 THEN CASE WHEN k % 2 = 0 THEN 'KR' ELSE 'VC_SQRT' END WHEN k % 3 = 1 THEN CASE WHEN k % 2 = 0 THEN 'VC_SQRT' ELSE 'NONE' END ELSE 'GW' END"
TRIPLES = f"""line AS (SELECT l_orderkey AS k, l_linenumber AS n, l_suppkey * 5000 AS bin, l_quantity AS q, CASE WHEN n_nationkey = 24 THEN 'ALL' ELSE n_name END AS chrom, n_nationkey AS o FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
raw AS (SELECT 'A' || a.k % 3 AS accession, {_NORM.replace("k %", "a.k %")} AS norm, CASE WHEN a.k // 7 % 2 = 0 THEN 5000 ELSE 25000 END AS resolution, a.chrom AS chrom1, a.o AS o1, a.bin AS bin1, b.chrom AS chrom2, b.o AS o2, b.bin AS bin2, sum(a.q + b.q) AS counts
  FROM line a JOIN line b ON a.k = b.k AND a.n < b.n WHERE a.chrom != 'ALL' AND b.chrom != 'ALL' GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9),
hic AS (SELECT accession, CASE WHEN o1 <= o2 THEN chrom1 ELSE chrom2 END AS chrom1, CASE WHEN o1 <= o2 THEN bin1 ELSE bin2 END AS start1, CASE WHEN o1 <= o2 THEN chrom2 ELSE chrom1 END AS chrom2, CASE WHEN o1 <= o2 THEN bin2 ELSE bin1 END AS start2, counts AS f, 'b' || accession AS biosample
  FROM raw WHERE resolution = 5000 AND norm = CASE accession WHEN 'A0' THEN 'KR' WHEN 'A1' THEN 'VC_SQRT' ELSE 'NONE' END AND counts > 40 AND o1 < 20 AND o2 < 20)"""


def _raw_triples(spark, sf_dir):
    """Pairs of an order's lines as contacts of suppliers, in several matrices a source, written as text and read back."""
    line, s, n = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    place = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.when(F.col("n_nationkey") == 24, "ALL").otherwise(F.col("n_name")).alias("chrom"))
    side = lambda k: line.join(place, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", F.col("l_linenumber").alias(f"n{k}"), F.col("chrom").alias(f"chrom{k}"), (F.col("l_suppkey") * 5000).alias(f"bin{k}"), F.col("l_quantity").alias(f"q{k}"))
    pairs = side(1).join(side(2), "l_orderkey").where("n1 < n2").withColumnRenamed("l_orderkey", "k")
    resolution = F.when(F.floor(F.col("k") / 7) % 2 == 0, 5000).otherwise(25000)
    keyed = pairs.withColumn("accession", F.concat(F.lit("A"), (F.col("k") % 3).cast("string"))).withColumn("norm", F.expr(_NORM)).withColumn("resolution", resolution)
    return keyed.groupBy("accession", "norm", "resolution", "chrom1", "bin1", "chrom2", "bin2").agg(F.sum(F.col("q1") + F.col("q2")).alias("counts"))


def _contacts(spark, sf_dir):
    path = new_path(spark, "triples")
    _raw_triples(spark, sf_dir).write.option("compression", "gzip").csv(path, sep="\t")
    triples = text.read_contact_triples(spark, path)
    info = triples.select("accession").distinct().withColumn("biosample", F.concat(F.lit("b"), "accession"))
    chroms = table(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.col("n_name").alias("chrom"), F.col("n_nationkey").alias("ord"))
    return triples, portal.contact_tokens(triples, info, 10000, chroms, True, 40.0)


@query(f"""WITH {TRIPLES} SELECT 'hic:' || accession || ':' || chrom1 || ':' || start1 || ':' || chrom2 || ':' || start2 AS token_id, chrom1, start1, start1 + 5000 AS end1, chrom2, start2, start2 + 5000 AS end2, f AS contact_freq,
accession AS experiment_accession, biosample, 5000 AS resolution FROM hic""")
def experiment_contacts(spark, sf_dir):
    """From the contact lists of several matrices to the tokens of the chosen one of each source, both ways of storing a pair."""
    return _contacts(spark, sf_dir)[1].withColumn("contact_freq", F.col("contact_freq").cast("double"))


@query(f"""WITH {TRIPLES} SELECT accession, array_to_string(list_sort(list(DISTINCT resolution)), ',') AS resolutions, array_to_string(list_sort(list(DISTINCT norm)), ',') AS norms, len(list_distinct(list_concat(list(chrom1), list(chrom2)))) AS n_chroms FROM raw GROUP BY 1""")
def contact_catalog(spark, sf_dir):
    triples = text.real_chromosomes(_raw_triples(spark, sf_dir))
    return text.contact_catalog(triples).select("accession", F.array_join(F.col("resolutions").cast("array<string>"), ",").alias("resolutions"), F.array_join("norms", ",").alias("norms"), F.size("chroms").cast("long").alias("n_chroms"))


@query(f"""WITH {AREAS}, {TRIPLES} SELECT 'TF ChIP-seq' AS assay, accession AS experiment_accession, 'b' || id % 2 AS biosample, 't' || id % 3 AS target, count(*) AS n_tokens, count(DISTINCT chrom) AS n_chroms, coalesce(round(median(auc), 3), -1) AS median_auc FROM t GROUP BY 2, 3, 4
UNION ALL SELECT 'Hi-C', accession, biosample, '', count(*), count(DISTINCT chrom1), -1 FROM hic GROUP BY 2, 3""")
def portal_summary(spark, sf_dir):
    """Tokens of all experiments of both kinds, written by assay and experiment, read back merged and summed up."""
    path = new_path(spark, "portal")
    portal.write_all(portal.finish_peaks(_experiment_peaks(spark, sf_dir).drop("token_id")), _contacts(spark, sf_dir)[1], path)
    schema = "assay string, experiment_accession string, biosample string, target string, n_tokens long, n_chroms long, median_auc double"
    summary = spark.read.schema(schema).csv(f"{path}/summary", sep="\t", header=True, nanValue="NaN", emptyValue="").na.fill("", ["target"])
    return summary.withColumn("median_auc", F.round(F.nanvl("median_auc", F.lit(-1.0)), 3))


@query(f"""WITH {AREAS} SELECT accession AS experiment_accession, count(*) AS n, count(*) FILTER (WHERE auc IS NULL) AS n_missing, count(DISTINCT chrom) AS n_tracks FROM t GROUP BY 1""")
def quality_counters(spark, sf_dir):
    return experiments.counters(_experiment_peaks(spark, sf_dir), "experiment_accession", "chrom", "auc")


@query("""SELECT * FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS token_id, 'c' || l_suppkey % 5 AS chrom, l_partkey AS start FROM lineitem)""")
def token_tables(spark, sf_dir):
    """Tokens written by chromosome, a part of them once more, and read back together."""
    line, path = table(spark, sf_dir, "lineitem"), new_path(spark, "tokens")
    tokens = line.select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("token_id"), F.concat(F.lit("c"), (F.col("l_suppkey") % 5).cast("string")).alias("chrom"), F.col("l_partkey").alias("start"))
    sinks.write_tokens(tokens.where("chrom != 'c3'"), path)
    sinks.write_tokens(tokens.where("chrom IN ('c3', 'c4')"), path)
    return sinks.read_tokens(spark, path).select("token_id", "chrom", "start")


@query("""SELECT token_id, chrom, start FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS token_id, 'c' || l_suppkey % 5 AS chrom, l_partkey AS start FROM lineitem) ORDER BY token_id, chrom, start LIMIT 10000""")
def readable_tokens(spark, sf_dir):
    """The readable form holds the first ten thousand rows in order."""
    line, path = table(spark, sf_dir, "lineitem"), new_path(spark, "tokens")
    tokens = line.select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("token_id"), F.concat(F.lit("c"), (F.col("l_suppkey") % 5).cast("string")).alias("chrom"), F.col("l_partkey").alias("start"))
    sinks.write_tokens(tokens, path, order=("token_id", "chrom", "start"))
    return spark.read.schema("token_id string, chrom string, start bigint").csv(f"{path}/tsv", sep="\t", header=True)


@query(f"""WITH {DAILY} SELECT chrom, day AS start, day + 1 AS "end", CAST(sum(q) AS DOUBLE) AS value FROM d GROUP BY 1, 2""")
def signal_ranges(spark, sf_dir):
    """Signals as ranges in text, compressed, read back."""
    path = new_path(spark, "ranges")
    rows = _daily(spark, sf_dir).groupBy("chrom", "day").agg(F.sum("q").cast("double").alias("value"))
    rows.select("chrom", F.col("day").alias("start"), (F.col("day") + 1).alias("end"), "value").write.option("compression", "gzip").csv(path, sep="\t")
    return text.read_segments(spark, path)


@query("""SELECT 'chr' || l_suppkey AS chrom, l_partkey AS start, l_partkey + l_linenumber AS "end", CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber ELSE 0 END AS score FROM lineitem""")
def gzip_narrow_peak(spark, sf_dir):
    """Compressed peak files; malformed whole numbers count as 0 in the lenient form."""
    path, n = new_path(spark, "narrow"), F.col("l_linenumber")
    line = table(spark, sf_dir, "lineitem")
    value = F.concat_ws("\t", F.concat(F.lit("chr"), F.col("l_suppkey").cast("string")), F.col("l_partkey").cast("string"), (F.col("l_partkey") + n).cast("string"), F.lit("x"), F.when(n % 2 == 0, n.cast("string")).otherwise(F.lit("bad")))
    line.select(value.alias("value")).write.option("compression", "gzip").text(path)
    return text.read_narrow_peak(spark, path, lenient=True).select("chrom", "start", "end", "score")


@query("""SELECT event_id, '' AS biosample, event_type, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN NULL ELSE round(value, 4) END AS safe FROM events""")
def json_safe_columns(spark, sf_dir):
    """A missing column comes as empty text; NaN and infinities as null."""
    e = table(spark, sf_dir, "events")
    odd = F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).when(F.col("event_id") % 3 == 1, F.lit(float("-inf"))).otherwise(F.round("value", 4))
    return experiments.ordered_columns(e.withColumn("safe", N.finite_or_null(odd)), ["event_id", "biosample", "event_type", "safe"])


@query("""SELECT o_custkey % 7 AS assay_key, a.title AS assay_title, count(*) AS n FROM orders JOIN (VALUES (0, 'TF ChIP-seq'), (1, 'ATAC-seq'), (2, 'Histone ChIP-seq'), (3, 'intact Hi-C')) a(k, title) ON a.k = o_custkey % 7 GROUP BY 1, 2""")
def assay_titles(spark, sf_dir):
    """Look-up of a few named values."""
    names = F.element_at(F.array(*map(F.lit, ["TF-ChIP-seq", "ATAC-seq", "ChIP-seq", "Hi-C", "x", "y", "z"])), (F.col("o_custkey") % 7 + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 7).alias("assay_key"), N.assay_title(names).alias("assay_title"))
    return rows.where("assay_title IS NOT NULL").groupBy("assay_key", "assay_title").agg(F.count("*").alias("n"))


@query(f"""WITH {ORDER_TRACKS} SELECT chrom, bin, count(*) AS n FROM t WHERE name = '1-URGENT' GROUP BY 1, 2""")
def assay_filter(spark, sf_dir):
    """One assay's tokens from a table of several, written by assay so that only its part is read."""
    path = new_path(spark, "assays")
    _order_tracks(spark, sf_dir).withColumnRenamed("name", "assay").write.partitionBy("assay").parquet(path)
    return pipelines.of_assay(spark.read.parquet(path), "1-URGENT").groupBy("chrom", "bin").agg(F.count("*").alias("n"))


@query("""SELECT o_custkey AS query_id, 'none' AS chrom, o_orderkey AS pos, -1 AS distance, '' AS nearest FROM orders""")
def nearest_unknown_partition(spark, sf_dir):
    q = table(spark, sf_dir, "orders").select(F.lit("none").alias("chrom"), F.col("o_custkey").alias("query_id"), F.col("o_orderkey").alias("pos"))
    p = table(spark, sf_dir, "part").select(F.lit("some").alias("chrom"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("name"), F.col("p_partkey").alias("ord"))
    return nearest.nearest_point(q, p)


# ---- corners: numbers as text, white space, windows without tracks, names by chromosome, NaN ----


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber WHEN 1 THEN q WHEN 2 THEN q * 100 WHEN 3 THEN q WHEN 4 THEN 0 WHEN 5 THEN -q WHEN 6 THEN 0 ELSE 9007199254740993 + l_orderkey END AS whole,
CASE l_linenumber WHEN 1 THEN CAST(q + 0.5 AS DOUBLE) WHEN 2 THEN q * 100 WHEN 3 THEN q WHEN 4 THEN -1 WHEN 5 THEN -q - 0.5 WHEN 6 THEN 0.5 ELSE -2 END AS real
FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q FROM lineitem)""")
def numbers_as_text(spark, sf_dir):
    """Whole numbers are cut from any number and exact beyond 2**53; what only a programming language would call a number is none."""
    line, q, n = table(spark, sf_dir, "lineitem"), F.col("l_quantity").cast("long").cast("string"), F.col("l_linenumber")
    big = (F.lit(9007199254740993) + F.col("l_orderkey")).cast("string")
    given = F.when(n == 1, F.concat(q, F.lit(".5"))).when(n == 2, F.concat(q, F.lit("e2"))).when(n == 3, F.concat(F.lit(" "), q, F.lit(" "))).when(n == 4, F.concat(q, F.lit("d"))).when(n == 5, F.concat(F.lit("-"), q, F.lit(".5"))).when(n == 6, F.lit(".5")).otherwise(big)
    rows = line.select("l_orderkey", "l_linenumber", "l_partkey", N.lenient_long(given).alias("whole"), F.nanvl(N.lenient_float(given), F.lit(-1.0).cast("float")).cast("double").alias("real"))
    return rows.withColumn("real", F.when(n > 6, -2.0).otherwise(F.col("real")))


@query("""SELECT 'chr' || l_suppkey AS chrom, l_partkey AS start, l_partkey + 9 AS "end", CASE WHEN l_linenumber = 3 THEN '-1' ELSE 'n' END AS name, CASE WHEN l_linenumber = 4 THEN 5 ELSE -1 END AS score, '-1' AS strand FROM lineitem WHERE l_linenumber < 5""")
def narrow_peak_white_space(spark, sf_dir):
    """Blanks and tabs around a line go; a line of nothing else is none; fractions are cut."""
    n, chrom, start = F.col("l_linenumber"), F.concat(F.lit("chr"), F.col("l_suppkey").cast("string")), F.col("l_partkey").cast("string")
    end = (F.col("l_partkey") + 9).cast("string")
    core = lambda *more: F.concat_ws("\t", chrom, start, end, *map(F.lit, more))
    value = F.when(n == 1, F.concat(F.lit("\t "), core("n"), F.lit("\t"))).when(n == 2, F.concat(core("n"), F.lit(" \t\t"))).when(n == 3, core()).when(n == 4, F.concat(F.concat_ws("\t", chrom, F.concat(start, F.lit(".7")), end, F.lit("n\t5.2"))))
    lines = table(spark, sf_dir, "lineitem").select(value.otherwise(F.when(n == 5, F.lit("\t")).when(n == 6, F.lit(" \t# no peak")).otherwise(F.lit("\ttrack name"))).alias("value"))
    return text.parse_narrow_peak(lines).select("chrom", "start", "end", "name", "score", "strand")


@query(f"""WITH {MATRIX} SELECT 'contact:t:v:' || i || ':' || j AS token_id, i AS bin1_start, j AS bin2_start, f AS contact_freq
FROM cell WHERE k > 0 AND k < n - 1 AND i >= x0 AND i < x1 AND j >= x0 AND j < x1 AND i <= j AND f >= 0.001""")
def windows_without_tracks(spark, sf_dir):
    """The first and the last window file have no track: the others still are inner ones."""
    rows, windows = _matrix_rows(spark, sf_dir)
    path = F.concat(F.lit("/maps/v_"), F.col("start").cast("string"), F.lit("_"), F.col("end").cast("string"), F.lit(".npz"))
    files = arrays.window_files(windows.select(path.alias("path"))).select("chrom", "start", "end")
    inner = windows.where("window_idx > 0 AND window_idx < n_windows - 1").select("window_idx", "start", "end")
    held = rows.join(inner, "window_idx").select("chrom", "start", "end", F.col("track").alias("track_name"), "row_idx", "row")
    return matrices.contact_window_tokens(held, 1, 16, 1e-3, files).select("token_id", "bin1_start", "bin2_start", "contact_freq")


@query(f"""WITH {MATRIX}, t AS (SELECT i, round(sum(CASE WHEN f >= 0.0001 THEN f ELSE 0 END), 8) AS total FROM cell GROUP BY 1)
SELECT 'v' AS chrom, i AS bin, 'contact_total' AS name, total AS value FROM t UNION ALL SELECT 'w', i, 'contact_total_t', total FROM t UNION ALL SELECT 'w', i, 'contact_total_u_x', total FROM t""")
def contact_totals_by_chromosome(spark, sf_dir):
    """A chromosome with one track has a plain name, one with two has both names."""
    rows, windows = _matrix_rows(spark, sf_dir)
    named = lambda c, t: F.struct(F.lit(c).alias("c"), F.lit(t).alias("t"))
    tracks_ = rows.withColumn("at", F.explode(F.array(named("v", "t"), named("w", "t"), named("w", "U x"))))
    both = windows.withColumn("chrom", F.explode(F.array(F.lit("v"), F.lit("w"))))
    out = matrices.contact_totals(tracks_.select(F.col("at.c").alias("chrom"), "window_idx", F.col("at.t").alias("track"), "row_idx", "row"), both, 1)
    return out.select("chrom", "bin", "name", F.round("value", 8).alias("value"))


@query(f"""WITH {ORDER_TRACKS}, s AS (SELECT chrom, bin, track_idx, sum(value) AS value FROM t GROUP BY 1, 2, 3)
SELECT chrom, bin, name, CASE WHEN bool_or(track_idx = 4) AND name = 'odd' THEN -1 ELSE round(sum(CASE WHEN track_idx = 4 THEN 0 ELSE value END) / CASE name WHEN 'odd' THEN 2 ELSE 3 END, 3) END AS value
FROM (SELECT *, CASE WHEN track_idx IN (1, 4) THEN 'odd' ELSE 'even' END AS name FROM s) GROUP BY 1, 2, 3""")
def features_with_nan(spark, sf_dir):
    """The mean of a feature's tracks: one that lacks a bin counts as 0, NaN (here -1) stays."""
    signal = _order_tracks(spark, sf_dir).groupBy("chrom", "bin", "track_idx").agg(F.sum("value").alias("value")).withColumn("value", F.when(F.col("track_idx") == 4, F.lit(float("nan"))).otherwise(F.col("value")))
    numbers = signal.select("track_idx").distinct()
    names = numbers.select("track_idx", F.lit("x").alias("name"), F.when(F.col("track_idx").isin(1, 4), "odd").otherwise("even").alias("transcription_factor"))
    out = matrices.assay_columns(signal, names, "chip_tf")
    return out.select("chrom", "bin", "name", F.round(F.nanvl("value", F.lit(-1.0)), 3).alias("value"))


@query("""WITH p AS (SELECT l_orderkey AS k, l_linenumber AS n, s_nationkey * 100000 + s_suppkey AS c, CAST(l_quantity AS BIGINT) AS q FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
t AS (SELECT least(a.c, b.c) AS x, greatest(a.c, b.c) AS y, sum(a.q + b.q) AS counts FROM p a JOIN p b ON a.k = b.k AND a.n < b.n GROUP BY 1, 2)
SELECT 'r' || x // 100000 % 5 AS accession, 'KR' AS norm, 'n' || x // 100000 AS chrom1, x % 100000 * 10 AS bin1, 'n' || y // 100000 AS chrom2, y % 100000 * 10 AS bin2,
round(CAST(CAST(counts / ((1 + x % 3) / 2.0 * ((1 + y % 3) / 2.0)) AS FLOAT) AS DOUBLE), 2) AS counts FROM t""")
def hic_matrices(spark, sf_dir):
    """Contacts of suppliers as binary files with a normalisation, written by tasks and read back by blocks."""
    path = new_path(spark, "hic")
    line, s = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    place = s.select(F.col("s_suppkey").alias("l_suppkey"), (F.col("s_nationkey") * 100000 + F.col("s_suppkey")).cast("long").alias("c"))
    side = lambda k: line.join(place, "l_suppkey").select("l_orderkey", F.col("l_linenumber").alias(f"n{k}"), F.col("c").alias(f"c{k}"), F.col("l_quantity").cast("long").alias(f"q{k}"))
    pairs = side(1).join(side(2), "l_orderkey").where("n1 < n2")
    cells = pairs.groupBy(F.least("c1", "c2").alias("c1"), F.greatest("c1", "c2").alias("c2")).agg(F.sum(F.col("q1") + F.col("q2")).alias("counts"))
    chrom, bin_ = (lambda c: F.floor(F.col(c) / 100000)), (lambda c: F.col(c) % 100000)
    named = cells.select(F.concat(F.lit("r"), (chrom("c1") % 5).cast("string")).alias("accession"), chrom("c1").alias("one"), bin_("c1").alias("x"), chrom("c2").alias("two"), bin_("c2").alias("y"), "counts")
    n, size = (1 + (m or 0) for m in place.agg(F.max(chrom("c")), F.max(bin_("c"))).first())
    each = spark.range(n).crossJoin(F.broadcast(spark.range(5).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("accession"))))  # five files
    values = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda j: (1 + (F.col("id") * 100000 + j) % 3) / 2)
    vectors = each.select("accession", F.lit("KR").alias("norm"), F.col("id").alias("chrom"), values.alias("values"))
    hic.write_hic(named, vectors, path, [(f"n{k}", size * 10) for k in range(n)], 10, whole=True)
    counts = F.nullif(F.col("counts").cast("double"), F.lit(float("nan")))  # NaN: not known
    return hic.read_hic(spark, path, ["KR"]).select("accession", "norm", "chrom1", "bin1", "chrom2", "bin2", F.round(counts, 2).alias("counts"))
