"""Named queries over the driver tables, with their SQL twins.

The tables hold no genomes, so each operator runs on a structural analogue: hourly sums of events are tracks, nations and
suppliers are chromosomes, orders are intervals, vectors are matrix rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import naming as N
from strandline.operators import binning, classify, contacts, experiments, intervals, nearest, peaks, smoothing, tiling
from strandline.sources import text

FLAGSHIP = "call_peaks"
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- tracks: hourly sums of events by type, in whole cents so that sums are exact ----

START = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"


def event_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("pos", F.expr(f"timestampdiff(SECOND, {START}, ts)"))


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = event_seconds(spark, sf_dir)
    return e.groupBy(F.col("event_type").alias("track"), F.floor(F.col("pos") / 3600).alias("bin")).agg(F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))


def hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length of the tracks, as far as the last event: one row."""
    n = (F.max(F.floor(F.col("pos") / 3600)) + 1).alias("n_bins")
    return event_seconds(spark, sf_dir).agg(n).select(F.lit("month").alias("chrom"), F.col("n_bins").alias("chrom_size"), "n_bins")


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chrom, track, bin, value: every hour of every event type."""
    sums = _hourly(spark, sf_dir)
    names = table(spark, sf_dir, "events").select(F.col("event_type").alias("track")).distinct()
    grid = names.join(F.broadcast(hours(spark, sf_dir))).withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_bins") - 1)))  # one row
    return grid.join(sums, ["track", "bin"], "left").select("chrom", "track", "bin", (F.coalesce("cents", F.lit(0)) / 100).alias("value"))


TRACKS = """
b AS (SELECT event_type AS track, CAST(floor(date_diff('second', TIMESTAMP '2024-01-01', ts) / 3600.0) AS BIGINT) AS bin,
        CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1, 2),
hours AS (SELECT CAST(max(bin) + 1 AS BIGINT) AS n FROM b),
tracks AS (SELECT t.track, r.bin, CAST(coalesce(cents, 0) AS DOUBLE) / 100 AS value
  FROM (SELECT DISTINCT event_type AS track FROM events) t CROSS JOIN (SELECT unnest(range(n)) AS bin FROM hours) r LEFT JOIN b USING (track, bin))"""


def _pool_sql(factor: int, name: str = "value") -> str:
    return f"SELECT track, bin // {factor} AS bin, round(sum(value) / {factor}, 6) AS {name} FROM tracks WHERE bin < (SELECT n - n % {factor} FROM hours) GROUP BY 1, 2"


@query(f"WITH {TRACKS} {_pool_sql(4)}")
def mean_pool(spark, sf_dir):
    return binning.mean_pool(tracks(spark, sf_dir), hours(spark, sf_dir), 4).select("track", "bin", F.round("value", 6).alias("value"))


@query(f"""WITH {TRACKS}, p AS ({_pool_sql(7)}), g AS (SELECT DISTINCT track FROM tracks)
SELECT g.track, i AS bin, i * 7 AS start, least(i * 7 + 7, n) AS "end", coalesce(p.value, 0.0) AS value
FROM g CROSS JOIN (SELECT unnest(range(CAST(ceil(n / 7.0) AS BIGINT))) AS i, n FROM hours) r LEFT JOIN p ON p.track = g.track AND p.bin = r.i""")
def align_bins_zero_tail(spark, sf_dir):
    signal = tracks(spark, sf_dir)
    pooled = binning.align_bins(signal, hours(spark, sf_dir), 1, 7)
    grid = signal.select("chrom", "track").distinct().join(tiling.skeleton(hours(spark, sf_dir), 7), "chrom")
    out = grid.join(pooled, ["chrom", "track", "bin"], "left")
    return out.select("track", "bin", "start", "end", F.round(F.coalesce("value", F.lit(0.0)), 6).alias("value"))


@query(f"""WITH {TRACKS} SELECT track, f AS factor, bin // f AS bin, round(sum(value), 4) AS total, count(*) AS n_bins, round(sum(value) / count(*), 6) AS value
FROM tracks CROSS JOIN (SELECT unnest([4, 16, 168]) AS f) GROUP BY track, f, bin // f HAVING count(*) = f""")
def multires_rollup(spark, sf_dir):
    out = binning.roll_up(tracks(spark, sf_dir), (4, 16, 168))
    return out.select("track", "factor", "bin", F.round("total", 4).alias("total"), "n_bins", F.round("value", 6).alias("value"))


@query(f"""WITH {TRACKS}, p AS ({_pool_sql(24)}) SELECT bin * 24 AS start, bin * 24 + 24 AS "end",
{", ".join(f"coalesce(max(CASE WHEN track = '{t}' THEN value END), 0) AS {t}" for t in ("click", "error", "purchase", "signup", "view"))}
FROM p GROUP BY bin""")
def fixed_bin_matrix(spark, sf_dir):
    pooled = binning.align_bins(tracks(spark, sf_dir), hours(spark, sf_dir), 1, 24).withColumnRenamed("track", "name")
    pooled = pooled.withColumn("value", F.round("value", 6))
    return binning.feature_matrix(pooled, hours(spark, sf_dir), 24, ["click", "error", "purchase", "signup", "view"]).drop("chrom")


def _order_tracks(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    months = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("long")
    return o.groupBy(F.col("o_orderstatus").alias("chrom"), F.col("o_orderpriority").alias("name"), months.alias("bin"), (F.col("o_custkey") % 5).alias("track_idx")).agg(
        (F.sum(F.round(F.col("o_totalprice") * 100).cast("long")) / 100).alias("value")
    )


ORDER_TRACKS = """t AS (SELECT o_orderstatus AS chrom, o_orderpriority AS name, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS bin, o_custkey % 5 AS track_idx,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS value FROM orders GROUP BY 1, 2, 3, 4)"""


@query(f"WITH {ORDER_TRACKS} SELECT chrom, name, bin, round(avg(value), 6) AS value FROM t GROUP BY 1, 2, 3")
def true_mean_tracks(spark, sf_dir):
    return binning.merge_tracks(_order_tracks(spark, sf_dir)).withColumn("value", F.round("value", 6))


@query(f"""WITH {ORDER_TRACKS}, r AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY chrom, name, bin) AS n FROM t WINDOW w AS (PARTITION BY chrom, name, bin ORDER BY track_idx))
SELECT chrom, name, bin, round(sum(value * CASE WHEN i = 1 THEN pow(0.5, n - 1) ELSE pow(0.5, n - i + 1) END), 8) AS value FROM r GROUP BY 1, 2, 3""")
def incremental_pair_mean(spark, sf_dir):
    return binning.merge_tracks(_order_tracks(spark, sf_dir), "pairwise").withColumn("value", F.round("value", 8))


def smooth_sql(source: str, name: str = "smooth", digits: int = 6) -> str:
    return f"""k AS (SELECT d, exp(-d * d / 18.0) / sum(exp(-d * d / 18.0)) OVER () AS w FROM (SELECT unnest(range(-12, 13)) AS d)),
len AS (SELECT max(bin) + 1 AS n FROM {source}),
{name} AS (SELECT a.track, a.bin, round(sum(b.value * k.w), {digits}) AS value FROM {source} a CROSS JOIN k CROSS JOIN len JOIN {source} b
  ON b.track = a.track AND b.bin = CASE WHEN a.bin + k.d < 0 THEN -(a.bin + k.d) - 1 WHEN a.bin + k.d >= n THEN 2 * n - 1 - (a.bin + k.d) ELSE a.bin + k.d END GROUP BY 1, 2)"""


SMOOTH = smooth_sql("tracks")


def smoothed(spark, sf_dir):
    return smoothing.gaussian_smooth(tracks(spark, sf_dir), hours(spark, sf_dir), 3.0).withColumn("value", F.round("value", 6))


@query(f"WITH {TRACKS}, {SMOOTH} SELECT track, bin, value FROM smooth")
def gaussian_smooth(spark, sf_dir):
    return smoothed(spark, sf_dir).select("track", "bin", "value")


RUNS = """f AS (SELECT *, CASE WHEN value IS DISTINCT FROM lag(value) OVER (PARTITION BY track ORDER BY bin) THEN 1 ELSE 0 END AS new FROM {0}),
g AS (SELECT *, sum(new) OVER (PARTITION BY track ORDER BY bin) AS run FROM f),
runs AS (SELECT track, run, min(bin) AS a, max(bin) AS b, any_value(value) AS value FROM g GROUP BY 1, 2),
n AS (SELECT *, lag(value) OVER (PARTITION BY track ORDER BY run) AS l, lead(value) OVER (PARTITION BY track ORDER BY run) AS r FROM runs),
peak AS (SELECT track, (a + b) // 2 AS p, value AS h FROM n WHERE l < value AND r < value)"""


@query(f"WITH {TRACKS}, {RUNS.format('tracks')} SELECT track, p AS bin, h AS value FROM peak")
def local_maxima(spark, sf_dir):
    return peaks.local_maxima(tracks(spark, sf_dir)).select("track", "bin", "value")


#: From the highest peak down, each is kept unless one kept before is nearer than the distance: a list of those kept grows along.
SUPPRESS = """ranked AS (SELECT *, row_number() OVER (PARTITION BY track ORDER BY h DESC, p DESC) AS n FROM every_peak),
walk(track, n, kept) AS (SELECT DISTINCT track, CAST(0 AS BIGINT), CAST([] AS BIGINT[]) FROM ranked
  UNION ALL SELECT w.track, r.n, CASE WHEN len(list_filter(w.kept, lambda q: abs(q - r.p) < {0})) = 0 THEN list_append(w.kept, r.p) ELSE w.kept END FROM walk w JOIN ranked r ON r.track = w.track AND r.n = w.n + 1),
peak AS (SELECT e.* FROM every_peak e JOIN (SELECT track, unnest(arg_max(kept, n)) AS p FROM walk GROUP BY 1) USING (track, p))"""


def peaks_sql(source: str, resolution: int, distance: int = 0) -> str:
    """CTEs and the final SELECT that call peaks on a table (track, bin, value); distance: bins, if suppression acts."""
    runs = RUNS.format(source)
    if distance:
        runs = runs.replace("peak AS (", "every_peak AS (") + ", " + SUPPRESS.format(distance)
    return f"""{runs},
last AS (SELECT max(bin) AS z FROM {source}),
st AS (SELECT k.track, k.p, k.h, coalesce(max(s.bin) FILTER (WHERE s.bin < k.p AND s.value > k.h), -1) AS ls, coalesce(min(s.bin) FILTER (WHERE s.bin > k.p AND s.value > k.h), (SELECT z + 1 FROM last)) AS rs
  FROM peak k JOIN {source} s USING (track) GROUP BY 1, 2, 3),
pr AS (SELECT st.track, st.p, st.h, st.h - greatest(min(s.value) FILTER (WHERE s.bin > ls AND s.bin <= p), min(s.value) FILTER (WHERE s.bin >= p AND s.bin < rs)) AS prom
  FROM st JOIN {source} s USING (track) GROUP BY 1, 2, 3),
md AS (SELECT track, greatest(0.5 * median(value), 1e-4) AS least FROM {source} WHERE value > 0 GROUP BY 1),
ok AS (SELECT pr.*, h - prom * 0.5 AS height FROM pr JOIN md USING (track) WHERE prom >= least),
cr AS (SELECT ok.track, p, h, prom, height, coalesce(max(s.bin) FILTER (WHERE s.bin <= p AND s.value <= height), 0) AS i, coalesce(min(s.bin) FILTER (WHERE s.bin >= p AND s.value <= height), (SELECT z FROM last)) AS j
  FROM ok JOIN {source} s USING (track) GROUP BY 1, 2, 3, 4, 5),
ip AS (SELECT cr.*, i + CASE WHEN a.value < height THEN (height - a.value) / (a2.value - a.value) ELSE 0 END AS l, j - CASE WHEN b.value < height THEN (height - b.value) / (b2.value - b.value) ELSE 0 END AS r
  FROM cr JOIN {source} a ON a.track = cr.track AND a.bin = i LEFT JOIN {source} a2 ON a2.track = cr.track AND a2.bin = i + 1
  JOIN {source} b ON b.track = cr.track AND b.bin = j LEFT JOIN {source} b2 ON b2.track = cr.track AND b2.bin = j - 1),
wd AS (SELECT *, CAST(floor(l) AS BIGINT) AS lb, least(greatest(CAST(ceil(r) AS BIGINT), CAST(floor(l) AS BIGINT) + 1), (SELECT z + 1 FROM last)) AS rb FROM ip WHERE r - l >= 2)
SELECT wd.track, lb * {resolution} AS start, rb * {resolution} AS "end", p * {resolution} AS summit,
  round((sum(s.value) - (arg_min(s.value, s.bin) + arg_max(s.value, s.bin)) / 2) * {resolution}, 4) AS auc, h AS signal_value, round(prom, 6) AS prominence
FROM wd JOIN {source} s ON s.track = wd.track AND s.bin >= lb AND s.bin < rb GROUP BY wd.track, lb, rb, p, h, prom"""


PEAKS_SQL = f"WITH {TRACKS}, {SMOOTH}, {peaks_sql('smooth', 3600)}"


@query(PEAKS_SQL)
def call_peaks(spark, sf_dir):
    found = peaks.call_peaks(smoothed(spark, sf_dir), 3600, block=64)  # a dozen blocks in a month's hours
    return found.select("track", "start", "end", "summit", F.round("auc", 4).alias("auc"), "signal_value", F.round("prominence", 6).alias("prominence"))


@query(f"""WITH {TRACKS} SELECT track, median(value) FILTER (WHERE value > 0) AS median_nonzero, greatest(0.5 * median(value) FILTER (WHERE value > 0), 1e-4) AS min_prominence FROM tracks GROUP BY 1""")
def prominence_threshold(spark, sf_dir):
    return peaks.nonzero_median(tracks(spark, sf_dir)).drop("chrom")


# ---- tiling and stitching: nations as chromosomes, daily quantities as windowed predictions ----


def _nation_sizes(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    rows = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations
    return rows.groupBy(F.col("n_name").alias("chrom")).agg(F.sum(F.floor(F.abs("c_acctbal"))).alias("chrom_size"))


WINDOWS = """s AS (SELECT n_name AS chrom, CAST(sum(CAST(floor(abs(c_acctbal)) AS BIGINT)) AS BIGINT) AS chrom_size FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
m AS (SELECT *, CASE WHEN chrom_size <= 20000 THEN 1 ELSE CAST(ceil((chrom_size - 20000) / 10000.0) AS BIGINT) + 1 END AS n_windows FROM s),
i AS (SELECT *, unnest(range(n_windows)) AS window_idx FROM m),
w AS (SELECT *, window_idx * 10000 AS a, least(window_idx * 10000 + 20000, chrom_size) AS b FROM i)"""


@query(f'WITH {WINDOWS} SELECT chrom, chrom_size, window_idx, n_windows, a AS start, b AS "end", window_idx // 10 AS batch FROM w')
def tile_windows(spark, sf_dir):
    return tiling.assign_batches(tiling.generate_windows(_nation_sizes(spark, sf_dir), 20000, 10000))


@query(f"""WITH {WINDOWS} SELECT chrom, window_idx,
  CASE WHEN n_windows = 1 OR window_idx = 0 THEN a WHEN window_idx = n_windows - 1 THEN greatest(b - 10000, a) ELSE a + (b - a - 10000) // 2 END AS keep_start,
  CASE WHEN n_windows = 1 OR window_idx = n_windows - 1 THEN b WHEN window_idx = 0 THEN least(a + 10000, b) ELSE a + (b - a - 10000) // 2 + 10000 END AS keep_end FROM w""")
def window_keep_ranges(spark, sf_dir):
    return tiling.keep_ranges(tiling.generate_windows(_nation_sizes(spark, sf_dir), 20000, 10000), 10000).select("chrom", "window_idx", "keep_start", "keep_end")


def _days(column: str, since: str = "1995-01-01"):
    return F.datediff(F.col(column).cast("date"), F.lit(since).cast("date")).cast("long")


def _daily(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.groupBy(F.col("l_returnflag").alias("chrom"), F.col("l_linestatus").alias("track"), _days("l_shipdate").alias("day")).agg(F.sum(F.col("l_quantity").cast("long")).alias("q"))


DAILY = """d AS (SELECT l_returnflag AS chrom, l_linestatus AS track, CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS day, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem GROUP BY 1, 2, 3)"""


@query(f"""WITH {DAILY}, s AS (SELECT chrom, max(day) + 1 AS size FROM d GROUP BY 1),
m AS (SELECT *, CASE WHEN size <= 400 THEN 1 ELSE CAST(ceil((size - 400) / 200.0) AS BIGINT) + 1 END AS n FROM s),
i AS (SELECT *, unnest(range(n)) AS k FROM m), w AS (SELECT *, k * 200 AS a, least(k * 200 + 400, size) AS b FROM i),
r AS (SELECT *, CASE WHEN n = 1 OR k = 0 THEN a WHEN k = n - 1 THEN greatest(b - 200, a) ELSE a + (b - a - 200) // 2 END AS x,
  CASE WHEN n = 1 OR k = n - 1 THEN b WHEN k = 0 THEN least(a + 200, b) ELSE a + (b - a - 200) // 2 + 200 END AS y FROM w)
SELECT r.chrom, d.track, d.day AS bin, arg_max(d.q * (k + 1), k) AS value FROM r JOIN d ON d.chrom = r.chrom AND d.day >= greatest(a, x) AND d.day < least(b, y) GROUP BY 1, 2, 3""")
def stitch_tracks(spark, sf_dir):
    daily = _daily(spark, sf_dir)
    windows = tiling.generate_windows(daily.groupBy("chrom").agg((F.max("day") + 1).alias("chrom_size")), 400, 200)
    # a window's prediction for a day: the day's quantity times the window's number, so that windows differ; a day lies in two windows
    at = F.explode(F.sequence(F.greatest(F.floor((F.col("day") - 400) / 200) + 1, F.lit(0).cast("long")), F.floor(F.col("day") / 200)))
    local = daily.withColumn("window_idx", at).select("chrom", "window_idx", "track", (F.col("day") - F.col("window_idx") * 200).alias("local_bin"), (F.col("q") * (F.col("window_idx") + 1)).alias("value"))
    return tiling.stitch(local, windows, 1, 200)


# ---- interval joins: orders as intervals over hours ----

_TYPES = ("click", "error", "purchase", "signup", "view")


def _order_intervals(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    start = (F.col("o_orderkey") * 977) % 2592000
    kind = F.element_at(F.array(*map(F.lit, _TYPES)), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return o.select(kind.alias("track"), F.col("o_orderkey").alias("interval_id"), start.alias("start"), (start + (F.col("o_custkey") % 50) * 600 + 1).alias("end"))


ORDER_INTERVALS = """v AS (SELECT (['click', 'error', 'purchase', 'signup', 'view'])[o_orderkey % 5 + 1] AS track, o_orderkey AS interval_id, (o_orderkey * 977) % 2592000 AS a, (o_orderkey * 977) % 2592000 + (o_custkey % 50) * 600 + 1 AS b FROM orders)"""


@query(f"""WITH {TRACKS}, {ORDER_INTERVALS} SELECT v.interval_id, v.track, any_value(a) AS start, any_value(b) AS "end", round(coalesce(avg(t.value), 0), 6) AS mean_value
FROM v LEFT JOIN tracks t ON t.track = v.track AND t.bin >= a // 3600 AND t.bin < greatest(a // 3600 + 1, CAST(ceil(b / 3600.0) AS BIGINT)) GROUP BY 1, 2""")
def overlap_mean(spark, sf_dir):
    out = intervals.overlap_mean(_order_intervals(spark, sf_dir), tracks(spark, sf_dir), 3600, ("track",))
    return out.select("interval_id", "track", "start", "end", F.round("mean_value", 6).alias("mean_value"))


@query(f"""WITH {TRACKS}, v AS (SELECT (['click', 'error', 'purchase', 'signup', 'view'])[o_orderkey % 5 + 1] AS track, o_orderkey AS interval_id, o_orderkey % 720 AS a, o_orderkey % 720 + o_custkey % 90 AS b FROM orders)
SELECT v.interval_id, v.track, round(coalesce(avg(t.value), 0), 9) AS mean_value FROM v LEFT JOIN tracks t ON t.track = v.track AND t.bin >= a AND t.bin < b GROUP BY 1, 2""")
def block_mean(spark, sf_dir):
    signal = tracks(spark, sf_dir)
    blocks = signal.groupBy("track", F.floor(F.col("bin") / 64).alias("block_idx")).agg(F.transform(F.array_sort(F.collect_list(F.struct("bin", "value"))), lambda s: s["value"]).alias("values"))
    o = _order_intervals(spark, sf_dir).join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("interval_id"), "o_custkey"), "interval_id")
    start = F.col("interval_id") % 720
    spans = o.select("track", "interval_id", start.alias("start"), (start + F.col("o_custkey") % 90).alias("end"))
    return intervals.block_mean(spans, blocks, 64, ("track",)).select("interval_id", "track", F.round("mean_value", 9).alias("mean_value"))


@query(f"""WITH {DAILY}, g AS (SELECT chrom, day, sum(q) AS q FROM d GROUP BY 1, 2),
v AS (SELECT (['A', 'N', 'R', 'X'])[o_orderkey % 4 + 1] AS chrom, o_orderkey AS interval_id, (o_orderkey * 7) % 2600 AS a, (o_orderkey * 7) % 2600 + o_custkey % 120 + 1 AS b FROM orders)
SELECT v.interval_id, v.chrom, round(coalesce(CAST(sum(g.q) AS DOUBLE) / count(g.q), 0) * any_value(b - a), 6) AS auc
FROM v LEFT JOIN g ON g.chrom = v.chrom AND g.day >= a AND g.day < b GROUP BY 1, 2""")
def interval_auc(spark, sf_dir):
    segments = _daily(spark, sf_dir).groupBy("chrom", "day").agg(F.sum("q").cast("double").alias("value")).select("chrom", F.col("day").alias("start"), (F.col("day") + 1).alias("end"), "value")
    o = table(spark, sf_dir, "orders")
    start = (F.col("o_orderkey") * 7) % 2600
    spans = o.select(F.element_at(F.array(*map(F.lit, "ANRX")), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("chrom"), F.col("o_orderkey").alias("interval_id"), start.alias("start"), (start + F.col("o_custkey") % 120 + 1).alias("end"))
    return intervals.interval_auc(spans, segments, 64).select("interval_id", "chrom", F.round("auc", 6).alias("auc"))


@query("""WITH e AS (SELECT CAST(user_id % 7 AS VARCHAR) AS chrom, event_id, event_type, CAST(date_diff('second', TIMESTAMP '2024-01-01', ts) AS BIGINT) AS pos FROM events),
q AS (SELECT * FROM e WHERE event_type = 'error'), p AS (SELECT * FROM e WHERE event_type = 'purchase' AND chrom != '6'),
c AS (SELECT q.chrom, q.event_id AS query_id, q.pos, abs(p.pos - q.pos) AS distance, p.event_id AS name,
  row_number() OVER (PARTITION BY q.event_id ORDER BY abs(p.pos - q.pos), CASE WHEN p.pos < q.pos THEN 0 ELSE 1 END, CASE WHEN p.pos < q.pos THEN -p.event_id ELSE p.event_id END) AS k
  FROM q JOIN p ON p.chrom = q.chrom)
SELECT q.chrom, q.event_id AS query_id, q.pos, coalesce(c.distance, -1) AS distance, coalesce(CAST(c.name AS VARCHAR), '') AS nearest FROM q LEFT JOIN c ON c.query_id = q.event_id AND c.k = 1""")
def nearest_point(spark, sf_dir):
    e = event_seconds(spark, sf_dir).withColumn("chrom", (F.col("user_id") % 7).cast("string"))
    q = e.where("event_type = 'error'").select("chrom", F.col("event_id").alias("query_id"), "pos")
    p = e.where("event_type = 'purchase' AND chrom != '6'").select("chrom", "pos", F.col("event_id").cast("string").alias("name"), F.col("event_id").alias("ord"))
    return nearest.nearest_point(q, p)


# ---- scores and classes: customers within nations ----


@query("""SELECT c_custkey, c_nationkey, round(CASE WHEN stddev_pop(c_acctbal) OVER w < 1e-9 THEN 0 ELSE (c_acctbal - avg(c_acctbal) OVER w) / stddev_pop(c_acctbal) OVER w END, 6) AS z
FROM customer WINDOW w AS (PARTITION BY c_nationkey)""")
def zscore_by_partition(spark, sf_dir):
    out = classify.zscore(table(spark, sf_dir, "customer"), ["c_acctbal"], "c_nationkey")
    return out.select("c_custkey", "c_nationkey", F.round("c_acctbal_z", 6).alias("z"))


@query("""WITH o AS (SELECT o_custkey AS k, count(*) AS n, CAST(sum(CAST(o_totalprice AS BIGINT)) AS BIGINT) AS p FROM orders GROUP BY 1),
r AS (SELECT c_custkey, c_mktsegment AS g, CAST(c_acctbal AS BIGINT) AS a, coalesce(n, 0) AS n, coalesce(p, 0) AS p, c_custkey * 37 % 4000 AS d FROM customer LEFT JOIN o ON k = c_custkey),
z AS (SELECT c_custkey, d, (a - avg(a) OVER w) / stddev_pop(a) OVER w AS x, (n - avg(n) OVER w) / stddev_pop(n) OVER w AS y, (p - avg(p) OVER w) / stddev_pop(p) OVER w AS t FROM r WINDOW w AS (PARTITION BY g))
SELECT c_custkey, d AS distance, CASE WHEN CAST(x AS FLOAT) >= CAST(1.2 AS FLOAT) AND d <= 200 THEN 'PLS' WHEN CAST(x AS FLOAT) >= CAST(1.2 AS FLOAT) THEN 'DNase-H3K4me3' WHEN CAST(y AS FLOAT) >= CAST(1.2 AS FLOAT) AND d <= 2000 THEN 'pELS'
  WHEN CAST(y AS FLOAT) >= CAST(1.2 AS FLOAT) THEN 'dELS' WHEN CAST(t AS FLOAT) >= CAST(1.2 AS FLOAT) THEN 'CTCF-only' ELSE 'low-DNase' END AS label FROM z""")
def classify_rules(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum(F.round("o_totalprice").cast("long")).alias("p"))
    c = table(spark, sf_dir, "customer")
    rows = c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "c_mktsegment", F.round("c_acctbal").cast("long").alias("a"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("p", F.lit(0)).alias("p"), (F.col("c_custkey") * 37 % 4000).alias("distance"))
    rows = classify.zscore(rows, ["a", "n", "p"], "c_mktsegment")
    return rows.select("c_custkey", "distance", classify.element_class(F.col("a_z"), F.col("n_z"), F.col("p_z"), F.col("distance"), 1.2).alias("label"))


# ---- contacts: products of vectors in windows; suppliers that share an order ----


def _matrix_rows(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("i"), F.col("embedding").cast("array<double>").alias("x"))
    sizes = e.agg((F.max("i") + 1).alias("chrom_size")).select(F.lit("v").alias("chrom"), "chrom_size")
    windows = tiling.generate_windows(sizes, 32, 16)
    at = e.withColumn("window_idx", F.explode(F.sequence(F.greatest(F.floor((F.col("i") - 32) / 16) + 1, F.lit(0).cast("long")), F.floor(F.col("i") / 16))))
    at = at.join(windows.select("window_idx", "start"), "window_idx")
    row = F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"])
    vectors = at.groupBy("window_idx").agg(row.alias("xs"))  # 32 at most
    rows = at.join(vectors, "window_idx").select(F.lit("v").alias("chrom"), "window_idx", F.lit("t").alias("track"), (F.col("i") - F.col("start")).alias("row_idx"), F.transform("xs", lambda y: F.round(F.abs(F.aggregate(F.zip_with(y, F.col("x"), lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)), 8)).alias("row"))
    return rows, windows


MATRIX = """e AS (SELECT vec_id AS i, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), s AS (SELECT max(i) + 1 AS size FROM e),
m AS (SELECT size, CASE WHEN size <= 32 THEN 1 ELSE CAST(ceil((size - 32) / 16.0) AS BIGINT) + 1 END AS n FROM s), ix AS (SELECT *, unnest(range(n)) AS k FROM m),
w AS (SELECT *, k * 16 AS a, least(k * 16 + 32, size) AS b FROM ix),
r AS (SELECT *, CASE WHEN n = 1 OR k = 0 THEN a WHEN k = n - 1 THEN greatest(b - 16, a) ELSE a + (b - a - 16) // 2 END AS x0,
  CASE WHEN n = 1 OR k = n - 1 THEN b WHEN k = 0 THEN least(a + 16, b) ELSE a + (b - a - 16) // 2 + 16 END AS x1 FROM w),
cell AS (SELECT r.*, p.i AS i, q.i AS j, round(abs(list_dot_product(p.x, q.x)), 8) AS f FROM r JOIN e p ON p.i >= a AND p.i < b JOIN e q ON q.i >= a AND q.i < b)"""


@query(f"""WITH {MATRIX} SELECT 'contact:t:v:' || i * 100 || ':' || j * 100 AS token_id, 'v' AS chrom, i * 100 AS bin1_start, i * 100 + 100 AS bin1_end, j * 100 AS bin2_start, j * 100 + 100 AS bin2_end,
f AS contact_freq, 't' AS track_name, 100 AS resolution FROM cell WHERE i >= x0 AND i < x1 AND j >= x0 AND j < x1 AND i <= j AND f >= 0.001""")
def contact_triangle_tokens(spark, sf_dir):
    rows, windows = _matrix_rows(spark, sf_dir)
    scaled = windows.select("chrom", "window_idx", "n_windows", (F.col("start") * 100).alias("start"), (F.col("end") * 100).alias("end"), "chrom_size")
    return contacts.contact_tokens(rows, scaled, 100, 1600, 1e-3)


@query(f"WITH {MATRIX} SELECT i AS bin, round(sum(CASE WHEN f >= 0.001 THEN f ELSE 0 END), 8) AS total FROM cell GROUP BY 1")
def contact_row_totals(spark, sf_dir):
    rows, windows = _matrix_rows(spark, sf_dir)
    return contacts.contact_row_totals(rows, windows, 1, 1e-3).select("bin", F.round("total", 8).alias("total"))


def _supplier_triples(spark, sf_dir):
    line, s, n = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    place = s.join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("chrom"))  # 25 nations
    side = lambda k: line.join(place, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", F.col("l_linenumber").alias(f"n{k}"), F.col("chrom").alias(f"chrom{k}"), (F.col("l_suppkey") * 10).alias(f"bin{k}"), F.col("l_quantity").alias(f"q{k}"))
    pairs = side(1).join(side(2), "l_orderkey").where("n1 < n2")
    counts = pairs.groupBy("chrom1", "bin1", "chrom2", "bin2").agg(F.sum(F.col("q1") + F.col("q2")).alias("counts"))
    return counts.withColumn("accession", F.lit("all")), n.where("n_nationkey < 20").select(F.col("n_name").alias("chrom"), F.col("n_nationkey").alias("ord"))


TRIPLES = """p AS (SELECT l.l_orderkey AS k, l.l_linenumber AS n, l.l_suppkey * 10 AS bin, l.l_quantity AS q, n_name AS chrom, n_nationkey AS o FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
t AS (SELECT a.chrom AS chrom1, a.o AS o1, a.bin AS start1, b.chrom AS chrom2, b.o AS o2, b.bin AS start2, sum(a.q + b.q) AS counts FROM p a JOIN p b ON a.k = b.k AND a.n < b.n GROUP BY 1, 2, 3, 4, 5, 6)"""
_SIDES = ", ".join(f"CASE WHEN o1 <= o2 THEN {a} ELSE {b} END AS {a}" for a, b in (("chrom1", "chrom2"), ("start1", "start2"), ("chrom2", "chrom1"), ("start2", "start1")))
_HIC = f"SELECT *, start1 + 10 AS end1, start2 + 10 AS end2 FROM (SELECT 'all' AS accession, {_SIDES}, counts AS contact_freq, 10 AS resolution FROM t WHERE counts > 60 AND o1 < 20 AND o2 < 20"


@query(f"WITH {TRIPLES} {_HIC} AND o1 = o2)")
def sparse_contacts_cis(spark, sf_dir):
    return contacts.sparse_contacts(_supplier_triples(spark, sf_dir)[0], 10, _supplier_triples(spark, sf_dir)[1], False, 60.0)


@query(f"WITH {TRIPLES} {_HIC})")
def sparse_contacts_trans(spark, sf_dir):
    return contacts.sparse_contacts(_supplier_triples(spark, sf_dir)[0], 10, _supplier_triples(spark, sf_dir)[1], True, 60.0)


@query("""WITH c AS (SELECT DISTINCT l_suppkey AS accession, CAST(l_quantity AS BIGINT) * 1000 AS r FROM lineitem)
SELECT accession, CAST(arg_min(r, abs(r - 15500) * 1000000 + r) AS INT) AS resolution FROM c GROUP BY 1""")
def nearest_resolution(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("accession"), (F.col("l_quantity").cast("int") * 1000).alias("resolution")).distinct()
    return contacts.nearest_resolution(c, 15500)


_NORMS = {"1-URGENT": "VC_SQRT", "2-HIGH": "NONE", "3-MEDIUM": "KR", "4-NOT SPECIFIED": "SCALE"}


@query("""SELECT o_custkey AS accession, CASE WHEN bool_or(o_orderpriority = '3-MEDIUM') THEN 'KR' WHEN bool_or(o_orderpriority = '1-URGENT') THEN 'VC_SQRT' ELSE 'NONE' END AS norm FROM orders GROUP BY 1""")
def preferred_norm(spark, sf_dir):
    names = F.create_map(*(F.lit(x) for kv in _NORMS.items() for x in kv))
    return contacts.preferred_normalisation(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("accession"), F.coalesce(names[F.col("o_orderpriority")], F.lit("OTHER")).alias("norm")))


# ---- text formats, experiments and files ----


@query("""WITH t AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CAST(l_quantity AS BIGINT) AS q FROM lineitem WHERE l_linenumber != 7)
SELECT 'chr' || l_suppkey AS chrom, l_partkey AS start, l_partkey + q AS "end", 'p' || l_orderkey AS name, CASE WHEN l_linenumber >= 5 THEN -1 ELSE l_linenumber END AS score,
CASE WHEN l_linenumber >= 5 THEN '-1' ELSE '.' END AS strand, CASE WHEN l_linenumber >= 5 THEN -1 ELSE l_linenumber - 2 END AS peak_offset,
CASE WHEN l_linenumber < 5 AND l_linenumber >= 2 THEN l_partkey + l_linenumber - 2 ELSE (2 * l_partkey + q) // 2 END AS summit FROM t""")
def parse_narrow_peak(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    q, n = F.col("l_quantity").cast("long"), F.col("l_linenumber")
    core = [F.concat(F.lit("chr"), F.col("l_suppkey").cast("string")), F.col("l_partkey").cast("string"), (F.col("l_partkey") + q).cast("string"), F.concat(F.lit("p"), F.col("l_orderkey").cast("string"))]
    full = [*core, n.cast("string"), F.lit("."), F.col("l_discount").cast("string"), F.lit("1.5"), F.lit("x"), (n - 2).cast("string")]
    lines = line.select(F.when(n == 7, F.lit("# comment")).when(n >= 5, F.concat_ws("\t", *core)).otherwise(F.concat_ws("\t", *full)).alias("value"))
    return experiments.summits(text.parse_narrow_peak(lines)).select("chrom", "start", "end", "name", "score", "strand", "peak_offset", "summit")


def _nested_files(spark, sf_dir):
    """Orders with their lines as files, in the order of lines.  What is shuffled, collected and sorted are numbers; names are put in afterwards."""
    line = table(spark, sf_dir, "lineitem")
    signal, released = F.when(F.col("l_linestatus") == "O", 0).otherwise(1), F.when(F.col("l_returnflag") == "R", 0).otherwise(1)
    numbers = line.select(F.col("l_orderkey").alias("accession"), F.struct("l_linenumber", "l_partkey", "l_suppkey", signal.alias("signal"), released.alias("released")).alias("line"))
    outputs = F.array(*map(F.lit, (*experiments.PEAK_OUTPUTS, experiments.SIGNAL_OUTPUT, "signal p-value", "other")))

    def file(x):
        third, second = x["l_suppkey"] % 3, x["l_suppkey"] % 2
        return F.struct(
            F.when(x["signal"] == 0, "bed narrowPeak").otherwise("bigWig").alias("file_type"), F.when(x["released"] == 0, "archived").otherwise("released").alias("status"), F.when(third > 0, F.lit("GRCh38")).alias("assembly"),
            F.when(third == 0, F.when(second == 0, F.array(F.lit("hg19"), F.lit("GRCh38"))).otherwise(F.array(F.lit("hg19")))).alias("assemblies"),
            F.try_element_at(outputs, (x["l_partkey"] % 6 + 1).cast("int")).alias("output_type"), F.concat(F.lit("/f/"), x["l_linenumber"].cast("string")).alias("href"),
        )

    return numbers.repartition("accession").groupBy("accession").agg(F.sort_array(F.collect_list("line")).alias("lines")).select("accession", F.transform("lines", file).alias("files"))


FILES_SQL = """f AS (SELECT l_orderkey AS k, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS place, l_linestatus = 'O' AS peak, l_partkey % 6 AS o,
    (['IDR thresholded peaks', 'optimal IDR thresholded peaks', 'pseudoreplicated IDR thresholded peaks', 'fold change over control', 'signal p-value', 'other'])[l_partkey % 6 + 1] AS output
  FROM lineitem WHERE l_returnflag != 'R' AND (l_suppkey % 3 > 0 OR l_suppkey % 2 = 0)),
r AS (SELECT *, row_number() OVER (PARTITION BY k, peak ORDER BY CASE WHEN peak THEN CASE WHEN o < 3 THEN o ELSE 99 END ELSE CASE o WHEN 3 THEN 0 WHEN 4 THEN 1 ELSE 2 END END, place) AS n FROM f)"""


@query(f"""WITH {FILES_SQL} SELECT k AS accession, max(CASE WHEN peak THEN '/f/' || l_linenumber END) AS peak_href, max(CASE WHEN NOT peak THEN 'https://files.example/f/' || l_linenumber END) AS signal_url FROM r WHERE n = 1 GROUP BY 1 HAVING peak_href IS NOT NULL""")
def best_file_priority(spark, sf_dir):
    best = _nested_files(spark, sf_dir).select("accession", experiments.best_peak_file(F.col("files"), "GRCh38").alias("p"), experiments.best_signal_file(F.col("files"), "GRCh38").alias("s"))
    return best.where("p IS NOT NULL").select("accession", F.col("p.href").alias("peak_href"), N.file_url("s.href", "https://files.example").alias("signal_url"))


@query("""SELECT o_custkey, o_orderstatus, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS n FROM orders) WHERE n <= 2""")
def limit_per_group(spark, sf_dir):
    return experiments.limit_per_group(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus"], ["o_orderkey"], 2).select("o_custkey", "o_orderstatus", "o_orderkey")


@query("""SELECT l_returnflag AS assay, l_suppkey AS experiment_accession, 'b' || l_suppkey % 3 AS biosample, 't' || l_suppkey % 5 AS target, count(*) AS n_tokens, count(DISTINCT l_shipdate) AS n_chroms,
coalesce(round(median(CASE WHEN l_discount > 0.02 AND l_suppkey % 4 > 0 THEN l_extendedprice END), 4), -1) AS median_auc FROM lineitem GROUP BY 1, 2, 3, 4""")
def experiment_summary(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    auc = F.when((F.col("l_discount") > 0.02) & (F.col("l_suppkey") % 4 > 0), F.col("l_extendedprice")).otherwise(F.lit(float("nan")))
    tokens = line.select(F.col("l_returnflag").alias("assay"), F.col("l_suppkey").alias("experiment_accession"), F.concat(F.lit("b"), (F.col("l_suppkey") % 3).cast("string")).alias("biosample"), F.concat(F.lit("t"), (F.col("l_suppkey") % 5).cast("string")).alias("target"), F.col("l_shipdate").alias("chrom"), auc.alias("auc"))
    return experiments.summarise(tokens).withColumn("median_auc", F.round(F.nanvl("median_auc", F.lit(-1.0)), 4))


@query("""SELECT gene_id, transcript_id FROM (SELECT p_brand AS gene_id, p_partkey AS transcript_id, row_number() OVER (PARTITION BY p_brand ORDER BY (p_type = 'PROMO') DESC, CASE WHEN p_type = 'PROMO' THEN 0 ELSE -p_size END, p_partkey) AS n FROM part) WHERE n = 1""")
def gene_representative(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("gene_id"), F.col("p_partkey").alias("transcript_id"), (F.col("p_type") == "PROMO").alias("is_mane"), F.col("p_size").alias("span"), F.col("p_partkey").alias("first_line"))
    return nearest.representatives(rows).select("gene_id", "transcript_id")


@query("""SELECT o_custkey, max_by(o_totalprice, o_orderkey) AS o_totalprice, max_by(o_orderstatus, o_orderkey) AS o_orderstatus, min(o_orderkey) AS first_line FROM orders GROUP BY 1""")
def dedup_last_wins(spark, sf_dir):
    return nearest.last_wins(table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderstatus", "o_orderkey"), "o_custkey", "o_orderkey")


@query("""WITH p AS (SELECT p_partkey, p_brand, p_type = 'PROMO' AS m, p_size, p_partkey % 7 AS c, (p_partkey * 31) % 100000 + 1 AS s, p_partkey % 2 = 0 AS plus FROM part),
b AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY m DESC, CASE WHEN m THEN 0 ELSE -p_size END, p_partkey) AS n, min(p_partkey) OVER (PARTITION BY p_brand) AS ord FROM p)
SELECT 'chr' || c AS chrom, CASE WHEN plus THEN s - 1 ELSE s + p_size - 1 END AS pos, CASE WHEN p_partkey % 5 = 0 THEN p_brand ELSE 'g' || p_brand END AS name, ord FROM b WHERE n = 1""")
def tss_table(spark, sf_dir):
    p, start = table(spark, sf_dir, "part"), (F.col("p_partkey") * 31) % 100000 + 1
    name = F.when(F.col("p_partkey") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(' gene_name "g'), F.col("p_brand"), F.lit('";')))
    mane = F.when(F.col("p_partkey") % 2 == 0, F.lit(' tag "MANE_Select"; tag "basic";')).otherwise(F.lit(' tag "MANE Select"; tag "basic";'))
    tag = F.when(F.col("p_type") == "PROMO", mane).otherwise(F.lit(' tag "basic"; tag "MANE_Select";'))
    attributes = F.concat(F.lit('gene_id "'), F.col("p_brand"), F.lit('.3"; transcript_id "T'), F.col("p_partkey").cast("string"), F.lit('.1";'), name, tag)
    strand = F.when(F.col("p_partkey") % 2 == 0, "+").otherwise("-")
    lines = p.select(F.concat_ws("\t", F.concat(F.lit("chr"), (F.col("p_partkey") % 7).cast("string")), F.lit("x"), F.lit("transcript"), start.cast("string"), (start + F.col("p_size")).cast("string"), F.lit("."), strand, F.lit("."), attributes).alias("value"), F.col("p_partkey").alias("line_no"))
    return nearest.tss_table(text.parse_annotation(lines))


@query(r"""SELECT p_partkey, replace(replace(lower(p_name || '-' || p_type), ' ', '_'), '-', '_') AS slug,
CASE WHEN p_size % 3 = 0 THEN 'h3k' || p_size WHEN p_size % 3 = 1 THEN replace(lower(p_name), ' ', '_') ELSE 'histone_' || p_partkey END AS histone,
CASE WHEN p_size % 2 = 0 THEN lower(replace(p_brand, ' ', '_')) ELSE replace(lower(p_name), ' ', '_') END AS factor,
CASE WHEN p_size % 4 = 0 THEN 'contact_total' ELSE 'contact_total_' || lower(regexp_replace(p_brand, '[^A-Za-z0-9_]', '_', 'g')) END AS contact FROM part""")
def column_names(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    histone = F.when(size % 3 == 0, F.concat(F.lit("Histone ChIP-seq "), F.col("p_name"), F.lit(" H3K"), size.cast("string"))).when(size % 3 == 1, F.concat(F.lit("histone chip_seq  "), F.col("p_name"))).otherwise(F.lit(" "))
    factor = F.when(size % 2 == 0, F.col("p_brand")).otherwise(F.lit(""))
    return p.select(
        "p_partkey", N.assay_slug(F.concat_ws("-", "p_name", "p_type")).alias("slug"), N.histone_column(histone, key).alias("histone"),
        N.factor_column(F.concat(F.lit("TF ChIP-seq "), F.col("p_name")), factor, key).alias("factor"), N.contact_column("p_brand", F.when(size % 4 == 0, 1).otherwise(2)).alias("contact"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, 'tf_chip_seq:acc:' || l_suppkey || ':' || l_partkey || ':' || l_partkey + 5 AS peak_id, 'hic:acc:' || l_suppkey || ':' || l_partkey || ':' || l_orderkey || ':' || l_linenumber AS hic_id,
'ccre:' || l_suppkey || ':' || l_partkey || ':' || l_orderkey AS element_id FROM lineitem""")
def token_ids(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        "l_orderkey", "l_linenumber", "l_partkey", N.peak_token_id(N.assay_slug(F.lit("TF-ChIP-seq")), F.lit("acc"), "l_suppkey", "l_partkey", F.col("l_partkey") + 5).alias("peak_id"),
        N.hic_token_id(F.lit("acc"), "l_suppkey", "l_partkey", "l_orderkey", "l_linenumber").alias("hic_id"), N.element_token_id("l_suppkey", "l_partkey", "l_orderkey").alias("element_id"),
    )


@query("""WITH t AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS a, CASE WHEN event_id % 4 = 0 THEN '?' ELSE CAST(user_id AS VARCHAR) || '.5' END AS b FROM events)
SELECT event_id, coalesce(TRY_CAST(a AS BIGINT), 0) AS whole, coalesce(TRY_CAST(b AS DOUBLE), -1) AS real FROM t""")
def coerce_types(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rows = e.select("event_id", F.when(F.col("event_id") % 3 == 0, "n/a").otherwise(F.col("user_id").cast("string")).alias("a"), F.when(F.col("event_id") % 4 == 0, "?").otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".5"))).alias("b"))
    return rows.select("event_id", N.lenient_long("a").alias("whole"), F.nanvl(N.lenient_float("b"), F.lit(-1.0).cast("float")).cast("double").alias("real"))


@query("""SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, 'c' AS side FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, 's' FROM supplier""")
def union_by_name(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.lit("c").alias("side"))
    s = table(spark, sf_dir, "supplier").select(F.lit("s").alias("side"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    return c.unionByName(s)


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def resume_anti_join(spark, sf_dir):
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return experiments.still_to_do(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), done, ["o_orderkey"])


@query("""WITH e AS (SELECT o_orderkey AS accession, CASE WHEN o_orderstatus != 'P' THEN 'https://x/' || o_custkey || '/p.bed.gz' END AS p, CASE WHEN o_custkey % 2 = 0 THEN 'https://x/' || o_custkey || '/s' END AS s FROM orders)
SELECT accession, 'peak' AS role, p AS url, '.bed.gz' AS suffix FROM e WHERE p IS NOT NULL UNION ALL SELECT accession, 'signal', s, '.bin' FROM e WHERE s IS NOT NULL""")
def download_tasks(spark, sf_dir):
    base = F.concat(F.lit("https://x/"), F.col("o_custkey").cast("string"))
    e = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("accession"), F.when(F.col("o_orderstatus") != "P", F.concat(base, F.lit("/p.bed.gz"))).alias("peak_url"), F.when(F.col("o_custkey") % 2 == 0, F.concat(base, F.lit("/s"))).alias("signal_url"))
    return experiments.download_tasks(e).withColumn("suffix", N.url_suffix("url"))


from strandline import programs  # noqa: E402, F401  (registers its queries here)
