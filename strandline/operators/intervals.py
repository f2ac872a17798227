"""Interval joins rewritten to equi-joins on bins, so that they are dealt by key and never compare all pairs.

Bins form a hierarchy, FAN of a level to one of the next.  A range of bins is the union of some at each level (FAN - 1 at either end), so that a range of any length is
a few rows.  Of two intervals the longer one settles the level at which they are compared: there each touches two bins at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN = 4


def pieces(first: Column, end: Column) -> Column:
    """The bins first .. end - 1 as the fewest bins of a hierarchy: array of (level, node); a node of a level stands for FAN ** level bins."""

    def at(level: Column) -> Column:
        size = F.pow(F.lit(float(FAN)), level)
        a, b = F.ceil(first / size), F.floor(end / size)
        u, v = F.ceil(a / FAN) * FAN, F.floor(b / FAN) * FAN  # what lies between is for the level above
        near = F.concat(F.transform(F.sequence(F.lit(0), F.lit(2 * FAN - 3)), lambda k: a + k), F.transform(F.sequence(F.lit(0), F.lit(FAN - 2)), lambda k: v + k))
        mine = F.filter(F.array_distinct(near), lambda x: (x >= a) & (x < b) & ((u >= v) | (x < u) | (x >= v)))
        return F.transform(mine, lambda x: F.struct(level.alias("level"), x.alias("node")))

    levels = F.sequence(F.lit(0), F.greatest(F.ceil(F.log(F.greatest(end - first, F.lit(1))) / F.log(F.lit(float(FAN)))), F.lit(0)).cast("int"))
    short = F.transform(F.sequence(first, F.greatest(end - 1, first)), lambda x: F.struct(F.lit(0).alias("level"), x.alias("node")))
    few = (end > first) & (end - first <= FAN * FAN)  # bin by bin is as good
    return F.when(few, short).otherwise(F.flatten(F.transform(levels, at)))


def _node_sums(rows: DataFrame, keys: tuple[str, ...], bin_: str, top: int) -> DataFrame:
    """Sums of rows (keys, bin, s, n) in all bins of the hierarchy up to a level: keys, level, node, s, n."""
    each = rows.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(top))))
    node = F.floor(F.col(bin_) / F.pow(F.lit(float(FAN)), "level"))
    return each.groupBy(*keys, "level", node.alias("node")).agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def _top(ranges: DataFrame, first: Column, end: Column) -> int:
    """A level that no piece of the ranges lies above: one number."""
    longest, top = ranges.agg(F.max(end - first)).first()[0] or 0, 0
    while longest > FAN * FAN and FAN**top < longest:
        top += 1
    return top


def overlap_mean(intervals: DataFrame, signal: DataFrame, resolution: int, keys: tuple[str, ...] = ("chrom",)) -> DataFrame:
    """Mean of the bins that each interval touches (at least one), 0 where it touches none: intervals' columns and mean_value.

    intervals: keys, interval_id, start, end; signal: keys, bin, value.  Bins cut by an end count in full.  An interval of any length asks for the sums of some bins of a hierarchy.
    """
    first = F.floor(F.col("start") / resolution)
    end = F.greatest(first + 1, F.ceil(F.col("end") / resolution))
    ranges = intervals.select(*keys, "interval_id", pieces(first, end).alias("pieces"))
    rows = signal.where("value IS NOT NULL").select(*keys, "bin", F.col("value").alias("s"), F.lit(1).alias("n"))
    asked = ranges.select(*keys, "interval_id", F.inline("pieces"))
    sums = asked.join(_node_sums(rows, keys, "bin", _top(intervals, first, end)), [*keys, "level", "node"]).groupBy(*keys, "interval_id")
    means = sums.agg((F.sum("s") / F.sum("n")).alias("mean_value"))
    return intervals.join(means, [*keys, "interval_id"], "left").withColumn("mean_value", F.coalesce("mean_value", F.lit(0.0)))


def block_mean(intervals: DataFrame, blocks: DataFrame, block: int, keys: tuple[str, ...] = ("chrom",)) -> DataFrame:
    """overlap_mean for a signal of resolution 1 kept as arrays of ``block`` values (keys, block_idx, values): nothing is exploded to bases.

    An interval asks for the blocks of its two ends, and for sums of the blocks between."""
    low, high = F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block)
    spans = intervals.where("start < end").select(*keys, "interval_id", "start", "end", low.alias("low"), high.alias("high"))
    ends = spans.withColumn("block_idx", F.explode(F.array_distinct(F.array("low", "high"))))
    a = F.greatest(F.col("start") - F.col("block_idx") * block, F.lit(0))
    b = F.least(F.col("end") - F.col("block_idx") * block, F.size("values").cast("long"))
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda t, x: t + x)
    part = F.slice("values", (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))
    cut = ends.join(blocks.select(*keys, "block_idx", "values"), [*keys, "block_idx"]).select(*keys, "interval_id", total(part).alias("s"), F.size(part).cast("long").alias("n"))
    between = spans.where("high - low > 1").select(*keys, "interval_id", pieces(F.col("low") + 1, F.col("high")).alias("pieces"))
    whole = blocks.select(*keys, "block_idx", total(F.col("values")).alias("s"), F.size("values").cast("long").alias("n"))
    inner = between.select(*keys, "interval_id", F.inline("pieces")).join(_node_sums(whole, keys, "block_idx", _top(spans, F.col("low") + 1, F.col("high"))), [*keys, "level", "node"]).select(*keys, "interval_id", "s", "n")
    sums = cut.unionByName(inner).groupBy(*keys, "interval_id").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    out = intervals.join(sums, [*keys, "interval_id"], "left")
    return out.withColumn("mean_value", F.when(F.col("n") > 0, F.col("s") / F.col("n")).otherwise(0.0)).drop("s", "n")


#: Buckets of one level in a bucket of the next, and levels, of overlap_pairs.
STEP, LEVELS = 8, 14


def overlap_pairs(left: DataFrame, right: DataFrame, width: int, keys: tuple[str, ...] = ("chrom",)) -> DataFrame:
    """Pairs of half-open intervals that overlap: both sides' columns (right's ends as r_start, r_end) and overlap.

    An interval's own level has the smallest buckets (width * STEP ** level) that are as long as it; there, and above, it touches two at most.  Each side is dealt to the buckets of its own level and,
    for those longer on the other side, of the levels that the other side has.  A pair is taken at the higher of both levels, in the bucket where the overlap begins.
    """
    level = F.least(F.greatest(F.ceil(F.log((F.col("end") - F.col("start")) / width) / F.log(F.lit(float(STEP)))), F.lit(0)), F.lit(LEVELS)).cast("int")
    one, two = (df.where("start < end").withColumn("_own", level) for df in (left, right))

    size = F.lit(width) * F.pow(F.lit(float(STEP)), "_level")
    in_buckets = lambda df: df.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size))))
    home = lambda df: in_buckets(df.withColumn("_level", F.col("_own")))

    def above(df: DataFrame, other: DataFrame) -> DataFrame:
        levels = F.broadcast(other.select(F.col("_own").alias("_level")).distinct())  # LEVELS + 1 rows at most
        return in_buckets(df.withColumn("_level", F.explode(F.sequence(F.col("_own"), F.lit(LEVELS)))).join(levels, "_level", "left_semi"))

    renamed = lambda df: df.withColumnsRenamed({"start": "r_start", "end": "r_end", "_own": "_other"})
    on = [*keys, "_level", "_bucket"]
    longer_left = home(one).join(renamed(above(two, one)), on)
    longer_right = above(one, two).where("_level > _own").join(renamed(home(two)), on)
    pairs = longer_left.unionByName(longer_right).where("start < r_end AND r_start < end")
    pairs = pairs.where(F.col("_bucket") == F.floor(F.greatest("start", "r_start") / size)).drop("_bucket", "_level", "_own", "_other")
    return pairs.withColumn("overlap", F.least("end", "r_end") - F.greatest("start", "r_start"))


def interval_auc(intervals: DataFrame, segments: DataFrame, width: int, keys: tuple[str, ...] = ("chrom",), signals: DataFrame | None = None) -> DataFrame:
    """Area under a piecewise signal: mean over the covered bases times the interval's length; 0 where nothing covers it.

    intervals: keys, interval_id, start, end; segments: keys, start, end, value (not overlapping).  signals lists those that exist, by
    some of the keys (an accession, say): intervals of others have NaN.  Without it there is one signal; a chromosome that it lacks has 0.
    """
    pairs = overlap_pairs(intervals.select(*keys, "interval_id", "start", "end"), segments.select(*keys, "start", "end", "value"), width, keys)
    sums = pairs.groupBy(*keys, "interval_id").agg(F.sum(F.col("value") * F.col("overlap")).alias("s"), F.sum("overlap").alias("n"))
    out = intervals.join(sums, [*keys, "interval_id"], "left")
    area = F.coalesce(F.col("s") / F.col("n") * (F.col("end") - F.col("start")), F.lit(0.0))
    if signals is not None:
        by = [k for k in keys if k in signals.columns]
        out = out.join(signals.select(*by).distinct().withColumn("known", F.lit(True)), by, "left")
        area = F.when(F.col("known"), area).otherwise(F.lit(float("nan")))
    return out.withColumn("auc", area).drop("s", "n", "known")
