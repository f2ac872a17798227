"""Peaks of tracks of any length, from blocks of values (see operators.blocks): no task holds more than a block.

Each block is summed up once: its extremes, the maxima within it with what they see inside the block, and its staircases - the values that rise (or fall) above
all others between them and an end of the block.  What a maximum doesn't find in its own block is looked for in a hierarchy of extremes, FAN blocks to a row:
up until a row holds a block that is high (or low) enough, down to that block, then on its staircase.  That gives the bases of a prominence
(the nearest higher bin) and the ends of a width (the nearest bin below a height).  Peaks that are too near each other are settled in rounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators import blocks as B
from strandline.storage import written, written_noting

#: Blocks of one row of the hierarchy.
FAN = 256

_LISTS = {
    "p_bin": "long", "p_height": "double", "p_llow": "double", "p_lopen": "boolean", "p_rlow": "double", "p_ropen": "boolean",
    "left_up": "double", "left_up_low": "double", "right_up": "double", "right_up_low": "double",
    "left_down": "double", "left_down_bin": "long", "left_down_next": "double", "right_down": "double", "right_down_bin": "long", "right_down_next": "double",
}
_PLAIN = {
    "n": "long", "low": "double", "high": "double", "first": "double", "last": "double", "total": "double", "whole": "boolean",
    "h_end": "long", "h_right": "double", "h_rlow": "double", "h_ropen": "boolean", "t_start": "long", "t_left": "double", "t_llow": "double", "t_lopen": "boolean",
}


def _bases(values: list[float], lows: list[float]) -> tuple[list[float], list[bool]]:
    """For each of the tops from left to right, the least value between it and the nearest strictly higher one on its left, and whether there is none;
    lows: the least value between each top and the one before it."""
    out, open_, stack = [], [], []  # stack: (value, least since the entry below it)
    for v, low in zip(values, lows):
        while stack and stack[-1][0] <= v:
            low = min(low, stack.pop()[1])
        open_.append(not stack)
        stack.append((v, low))
        out.append(low)
    return out, open_


def _stairs(x: np.ndarray) -> np.ndarray:
    """Places from the left end of values that are higher than all before them."""
    best = np.maximum.accumulate(x)
    return np.flatnonzero(np.concatenate(([True], best[1:] > best[:-1])))


def summary(x: np.ndarray, start: int) -> dict[str, object]:
    """What a block that begins at bin ``start`` tells others."""
    n = len(x)
    heads = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    tails = np.append(heads[1:], n) - 1
    v = x[heads]
    inner = np.flatnonzero((v[1:-1] > v[:-2]) & (v[1:-1] > v[2:])) + 1
    middles = (heads[inner] + tails[inner]) // 2
    tops = np.unique(np.concatenate(([0], middles, [n - 1])))
    values = x[tops]
    valleys = np.minimum.reduceat(x, tops[:-1]) if len(tops) > 1 else np.empty(0)  # from each top to before the next
    between = np.minimum(valleys, values[1:])
    llow, lopen = (np.array(c) for c in _bases(values.tolist(), [values[0], *between.tolist()]))
    rlow, ropen = (np.array(c)[::-1] for c in _bases(values[::-1].tolist(), [values[-1], *between[::-1].tolist()]))
    at = np.searchsorted(tops, middles)
    ahead, behind = _stairs(x), n - 1 - _stairs(x[::-1])  # from the left end, from the right end
    down, back = _stairs(-x), n - 1 - _stairs(-x[::-1])
    least, since = np.minimum.accumulate(x), np.minimum.accumulate(x[::-1])[::-1]
    whole = len(heads) == 1
    return {
        "n": n, "low": float(x.min()), "high": float(x.max()), "first": float(x[0]), "last": float(x[-1]), "total": float(x.sum()), "whole": whole,
        "h_end": start + int(tails[0]), "h_right": None if whole else float(v[1]), "h_rlow": float(rlow[0]), "h_ropen": bool(ropen[0]),
        "t_start": start + int(heads[-1]), "t_left": None if whole else float(v[-2]), "t_llow": float(llow[-1]), "t_lopen": bool(lopen[-1]),
        "p_bin": start + middles, "p_height": x[middles], "p_llow": llow[at], "p_lopen": lopen[at], "p_rlow": rlow[at], "p_ropen": ropen[at],
        # met by one that comes from the right: from the block's right end leftwards; its least value on the way to each step
        "left_up": x[behind], "left_up_low": np.where(behind + 1 < n, since[np.minimum(behind + 1, n - 1)], np.inf),
        "right_up": x[ahead], "right_up_low": np.where(ahead > 0, least[np.maximum(ahead - 1, 0)], np.inf),
        "left_down": x[back], "left_down_bin": start + back, "left_down_next": np.where(back + 1 < n, x[np.minimum(back + 1, n - 1)], np.nan),
        "right_down": x[down], "right_down_bin": start + down, "right_down_next": np.where(down > 0, x[np.maximum(down - 1, 0)], np.nan),
    }


_ARROW = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}


def summaries(blocks: DataFrame, block: int = B.BLOCK, keys: tuple[str, ...] = ("chrom", "track")) -> tuple[DataFrame, int]:
    """A row a block: keys, block_idx and what summary() gives, written once; and the highest block_idx."""
    kinds = _PLAIN | _LISTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("block_idx").to_pylist()
            for i, (k, x) in enumerate(zip(at, B.values_of(batch.column("values")))):
                if len(x):
                    s = summary(x, k * block)
                    columns = [pa.array([s[c]], pa.list_(_ARROW[t]) if c in _LISTS else _ARROW[t]) for c, t in kinds.items()]
                    own = batch.slice(i, 1)
                    yield pa.RecordBatch.from_arrays([*(own.column(c) for c in (*keys, "block_idx")), *columns], names=[*keys, "block_idx", *kinds])

    schema = ", ".join([*B.key_fields(blocks, keys), "block_idx long", *(f"{c} {t}" for c, t in _PLAIN.items()), *(f"{c} array<{t}>" for c, t in _LISTS.items())])
    sums, last = written_noting(blocks.select(*keys, "block_idx", "values").mapInArrow(run, schema), "summaries", F.max("block_idx"))
    return sums, last or 0


def maxima(sums: DataFrame, block: int = B.BLOCK, keys: tuple[str, ...] = ("chrom", "track")) -> DataFrame:
    """All local maxima: keys, bin (the middle of a flat run), height, and for each side the least value seen in its own block (llow, rlow), whether nothing higher was
    (lopen, ropen), and that block (lblock, rblock).  Runs that touch an end of a block, two a block at most, are put together along the track."""
    lists = {c.removeprefix("p_"): c for c in _LISTS if c.startswith("p_")}
    zipped = F.arrays_zip(*(F.col(c).alias(a) for a, c in lists.items()))
    inner = sums.select(*keys, F.col("block_idx").alias("lblock"), F.inline(zipped)).withColumn("rblock", F.col("lblock"))
    start, end = F.col("block_idx") * block, F.col("block_idx") * block + F.col("n") - 1
    own = lambda low, open_: F.struct(low.alias("low"), open_.alias("open"))
    yes = F.lit(True)
    head = F.struct(start.alias("a"), F.when(F.col("whole"), end).otherwise(F.col("h_end")).alias("b"), F.col("first").alias("v"), F.lit(None).cast("double").alias("l"), F.col("h_right").alias("r"),
                    own(F.col("first"), yes).alias("left"), own(F.col("h_rlow"), F.col("h_ropen")).alias("right"))
    tail = F.struct(F.col("t_start").alias("a"), end.alias("b"), F.col("last").alias("v"), F.col("t_left").alias("l"), F.lit(None).cast("double").alias("r"),
                    own(F.col("t_llow"), F.col("t_lopen")).alias("left"), own(F.col("last"), yes).alias("right"))
    outer = sums.select(*keys, F.inline(F.when(F.col("whole"), F.array(head)).otherwise(F.array(head, tail))))
    w = Window.partitionBy(*keys).orderBy("a")
    new = F.when((F.col("v") == F.lag("v").over(w)) & (F.col("a") == F.lag("b").over(w) + 1), 0).otherwise(1)
    runs = outer.withColumn("new", new).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*keys, "run").agg(
        F.min_by("l", "a").alias("l"), F.max_by("r", "a").alias("r"), F.min_by("left", "a").alias("left"), F.max_by("right", "a").alias("right"),
        F.first("v").alias("height"), F.min("a").alias("a"), F.max("b").alias("b"),
    )
    w = Window.partitionBy(*keys).orderBy("a")
    runs = runs.withColumns({"l": F.coalesce("l", F.lag("height").over(w)), "r": F.coalesce("r", F.lead("height").over(w))}).where("l < height AND r < height")
    in_block = lambda c: F.floor(F.col(c) / block)
    edge = runs.select(
        *keys, in_block("a").alias("lblock"), F.floor((F.col("a") + F.col("b")) / 2).alias("bin"), "height", F.col("left.low").alias("llow"), F.col("left.open").alias("lopen"),
        F.col("right.low").alias("rlow"), F.col("right.open").alias("ropen"), in_block("b").alias("rblock"),
    )
    return inner.unionByName(edge)


def settle(bins: np.ndarray, heights: np.ndarray, own: np.ndarray, kept: np.ndarray, distance: int) -> np.ndarray:
    """1 kept, 2 removed, 0 open, for peaks by bin, of which only those that are ``own`` see all their neighbours.  From the highest down (of equal ones the
    rightmost), a peak is kept if all higher ones nearer than distance are removed, and removes the others."""
    state = np.where(kept, 1, 0)
    first, last = np.searchsorted(bins, bins - distance, "right"), np.searchsorted(bins, bins + distance, "left")
    order = np.lexsort((bins, heights))[::-1]
    rank = np.empty(len(bins), np.int64)
    rank[order] = np.arange(len(bins))
    for k in order.tolist():
        if state[k] == 2:
            continue
        a, b = first[k], last[k]
        if state[k] == 0:
            higher = rank[a:b] < rank[k]
            if not own[k] or (state[a:b][higher] != 2).any():
                continue
            state[k] = 1
        near = state[a:b]
        near[(rank[a:b] > rank[k]) & (near == 0)] = 2
    return state


def suppress(peaks: DataFrame, distance: int, zone: int, keys: tuple[str, ...] = ("chrom", "track")) -> DataFrame:
    """peaks (keys, bin, height, others) that stay when, from the highest down, each removes those nearer than distance; of equal ones the rightmost is first.

    A task settles a zone of bins with the peaks of its neighbours within the distance.  A peak stays open while a higher open one is near that a
    neighbour has to settle; rounds go on until none is open.  The highest open peak of all is settled in each, usually nearly all are in the first.
    """
    if distance <= 1:
        return peaks
    zone = max(zone, distance)
    state = peaks.select(*keys, "bin", "height", F.lit(False).alias("kept"))
    fields = ", ".join([*B.key_fields(peaks, keys), "bin long, height double, kept boolean"])

    def one(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("bin")
        bins, own = table.column("bin").to_numpy(), table.column("own").to_numpy(zero_copy_only=False)
        found = settle(bins, table.column("height").to_numpy(), own, table.column("kept").to_numpy(zero_copy_only=False), distance)
        out = table.set_column(table.schema.get_field_index("kept"), "kept", pa.array(found == 1))
        return out.filter(pa.array(own & (found != 2))).select([*keys, "bin", "height", "kept"])

    while True:
        home = F.floor(F.col("bin") / zone)
        zones = F.array_distinct(F.array(home, F.floor((F.col("bin") - distance + 1) / zone), F.floor((F.col("bin") + distance - 1) / zone)))
        sent = state.withColumn("zone", F.explode(zones)).withColumn("own", F.col("zone") == home)
        state, open_ = written_noting(sent.groupBy(*keys, "zone").applyInArrow(one, fields), "peaks", F.sum((~F.col("kept")).cast("long")))
        if not open_:
            break
    return peaks.join(state.select(*keys, "bin"), [*keys, "bin"], "left_semi")


class Hierarchy:
    """Extremes of blocks, FAN to a row, level upon level, until a row has a track's all.  entries: idx, low, high, by idx."""

    def __init__(self, sums: DataFrame, last: int, keys: tuple[str, ...], fan: int = FAN):
        self.keys, self.fan, self.levels, self.last = keys, fan, [], last
        rows = sums.select(*keys, F.col("block_idx").alias("idx"), "low", "high")
        while True:
            entries = F.array_sort(F.collect_list(F.struct("idx", "low", "high")))  # fan at most
            level = rows.groupBy(*keys, F.floor(F.col("idx") / fan).alias("row")).agg(entries.alias("entries"))
            last //= fan
            self.levels.append(written(level, "extremes") if last or self.levels else level)
            if not last:
                return
            rows = self.levels[-1].select(*keys, F.col("row").alias("idx"), F.array_min(F.transform("entries", lambda e: e["low"])).alias("low"), F.array_max(F.transform("entries", lambda e: e["high"])).alias("high"))

    def nearest(self, asked: DataFrame, left: bool, up: bool) -> DataFrame:
        """asked (keys, pos: a block, height, least, others) with target, the nearest block before (left) or after pos that holds a value above height (up), or
        one not above it; null if there is none.  least becomes the lowest value of the blocks between, too."""
        if not self.last:  # tracks of one block have no other
            return asked.withColumn("pos", F.lit(None).cast("long")).withColumnRenamed("pos", "target")
        fits = (lambda e, h: e["high"] > h) if up else (lambda e, h: e["low"] <= h)

        def look(rows: DataFrame, level: int, inside: bool) -> DataFrame:
            """One row of a level: only beyond pos, or anywhere in it (inside)."""
            found = rows.withColumn("row", F.col("pos") if inside else F.floor(F.col("pos") / self.fan)).join(self.levels[level], [*self.keys, "row"])
            entries = F.col("entries") if inside else F.filter("entries", lambda e: (e["idx"] < F.col("pos")) if left else (e["idx"] > F.col("pos")))
            hits = F.transform(F.filter("entries", lambda e: fits(e, F.col("height"))), lambda e: e["idx"])
            found = found.withColumn("entries", entries).withColumn("hit", F.array_max(hits) if left else F.array_min(hits))
            passed = F.filter("entries", lambda e: F.col("hit").isNull() | ((e["idx"] > F.col("hit")) if left else (e["idx"] < F.col("hit"))))
            return found.withColumn("least", F.least("least", F.array_min(F.transform(passed, lambda e: e["low"])))).drop("entries")

        rest, done = asked, []
        for k in range(len(self.levels)):
            seen = look(rest, k, False)
            if k + 1 < len(self.levels):
                seen = written(seen, "seen")  # both halves of it go on
            hits = seen.where("hit IS NOT NULL").withColumn("pos", F.col("hit")).drop("hit", "row")
            for below in range(k - 1, -1, -1):
                hits = look(hits, below, True).withColumn("pos", F.col("hit")).drop("hit", "row")
            done.append(hits.withColumnRenamed("pos", "target"))
            rest = seen.where("hit IS NULL").withColumn("pos", F.col("row")).drop("hit", "row")
        none = rest.withColumn("pos", F.lit(None).cast("long")).withColumnRenamed("pos", "target")
        return reduce(DataFrame.unionByName, [*done, none])


def prominences(peaks: DataFrame, sums: DataFrame, tree: Hierarchy, keys: tuple[str, ...]) -> DataFrame:
    """keys, bin, height, prominence: the height above the higher of the two bases, each the lowest value on the way to the nearest higher bin or the track's end."""
    if not tree.last:
        return peaks.select(*keys, "bin", "height", (F.col("height") - F.greatest("llow", "rlow")).alias("prominence"))
    sides = []
    for left, (block, low, open_) in ((True, ("lblock", "llow", "lopen")), (False, ("rblock", "rlow", "ropen"))):
        rows = peaks.select(*keys, "bin", "height", F.col(block).alias("pos"), F.col(low).alias("least"), F.col(open_).alias("open"))
        closed = rows.where("NOT open").select(*keys, "bin", "height", "least")
        found = tree.nearest(rows.where("open").drop("open"), left, True)
        step, low_ = ("left_up", "left_up_low") if left else ("right_up", "right_up_low")
        stairs = sums.select(*keys, F.col("block_idx").alias("target"), F.arrays_zip(F.col(step).alias("v"), F.col(low_).alias("low")).alias("stairs"))
        met = found.where("target IS NOT NULL").join(stairs, [*keys, "target"])
        first = F.get(F.filter("stairs", lambda s: s["v"] > F.col("height")), F.lit(0))
        met = met.select(*keys, "bin", "height", F.least("least", first["low"]).alias("least"))
        sides.append(closed.unionByName(met).unionByName(found.where("target IS NULL").select(*keys, "bin", "height", "least")))
    both = sides[0].unionByName(sides[1]).groupBy(*keys, "bin", "height").agg(F.max("least").alias("base"))
    return both.select(*keys, "bin", "height", (F.col("height") - F.col("base")).alias("prominence"))


def _crossing(x: np.ndarray, peaks: np.ndarray, level: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """For each peak the nearest bin in a direction that isn't above its level, or -1; and where the straight line from there meets it."""
    at, go = peaks.copy(), np.arange(len(peaks))
    while len(go):
        go = go[x[at[go]] > level[go]]
        at[go] += step
        out = (at[go] < 0) | (at[go] >= len(x))
        at[go[out]] = -1
        go = go[~out]
    met = at >= 0
    inner = np.clip(at - step, 0, len(x) - 1)
    below = met & (x[at] < level)
    rise = np.where(below, x[inner] - x[at], 1.0)
    return at, at - step * np.where(below, (level - x[at]) / rise, 0.0)


def _in_blocks(blocks: DataFrame, peaks: DataFrame, block: int, resolution: int, rel_height: float, keys: tuple[str, ...]) -> DataFrame:
    """peaks (keys, bin, height, prominence) with the ends of their widths (left, right) and area, as far as they lie in the peak's own block; else null."""
    mine = peaks.groupBy(*keys, F.floor(F.col("bin") / block).alias("block_idx")).agg(F.collect_list(F.struct("bin", "height", "prominence")).alias("peaks"))  # of a block
    rows = blocks.select(*keys, "block_idx", "values").join(mine, [*keys, "block_idx"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("peaks")
            at, flat = found.offsets.to_numpy(), found.values
            for i, (k, x) in enumerate(zip(batch.column("block_idx").to_pylist(), B.values_of(batch.column("values")))):
                part = flat.slice(int(at[i]), int(at[i + 1] - at[i]))
                bins, height, prominence = (part.field(c).to_numpy(zero_copy_only=False) for c in ("bin", "height", "prominence"))
                first = k * block
                level = height - prominence * rel_height
                (l_at, left), (r_at, right) = (_crossing(x, bins - first, level, s) for s in (-1, 1))
                both = (l_at >= 0) & (r_at >= 0)
                a = np.where(both, np.floor(left), 0).astype(np.int64)
                b = np.where(both, np.maximum(np.ceil(right), a + 1), 1).astype(np.int64)
                area = np.array([(x[i_:j].sum() - (x[i_] + x[j - 1]) / 2) * resolution for i_, j in zip(a, b)])
                n = len(bins)
                own = batch.slice(i, 1)
                same = pa.array(np.zeros(n, np.int64))
                out = [pa.array(bins), pa.array(height), pa.array(prominence), pa.array(left + first, mask=l_at < 0), pa.array(right + first, mask=r_at < 0), pa.array(area, pa.float64(), mask=~both)]
                yield pa.RecordBatch.from_arrays([*(own.column(c).take(same) for c in keys), *out], names=[*keys, "bin", "height", "prominence", "left", "right", "area"])

    schema = ", ".join([*B.key_fields(blocks, keys), "bin long, height double, prominence double, left double, right double, area double"])
    return rows.mapInArrow(run, schema)


def _ends(open_: DataFrame, sums: DataFrame, tree: Hierarchy, block: int, rel_height: float, keys: tuple[str, ...]) -> DataFrame:
    """Peaks whose width ends beyond their block: left and right filled in, from the staircases of the nearest blocks low enough, or the ends of the track."""
    along = Window.partitionBy(*keys).orderBy("block_idx")  # a row a block
    sums = sums.withColumns({"ahead": F.lead("first").over(along), "behind": F.lag("last").over(along), "length": F.sum("n").over(Window.partitionBy(*keys))})
    for side, left in (("left", True), ("right", False)):
        rows = open_.where(F.col(side).isNull()).withColumn("pos", F.floor(F.col("bin") / block))
        rows = rows.withColumns({"peak_height": F.col("height"), "height": F.col("height") - F.col("prominence") * rel_height, "least": F.col("height")})
        found = tree.nearest(rows, left, False)
        steps = F.arrays_zip(F.col(f"{side}_down").alias("v"), F.col(f"{side}_down_bin").alias("at"), F.col(f"{side}_down_next").alias("next"))
        stairs = sums.select(*keys, F.col("block_idx").alias("target"), steps.alias("stairs"), F.col("ahead" if left else "behind").alias("edge"))
        met = found.where("target IS NOT NULL").join(stairs, [*keys, "target"]).withColumn("s", F.get(F.filter("stairs", lambda s: s["v"] <= F.col("height")), F.lit(0)))
        inner = F.coalesce(F.nanvl(F.col("s.next"), F.col("edge")), F.col("edge"))
        part = F.when(F.col("s.v") < F.col("height"), (F.col("height") - F.col("s.v")) / (inner - F.col("s.v"))).otherwise(0.0)
        met = met.withColumn(side, (F.col("s.at") + part) if left else (F.col("s.at") - part)).drop("stairs", "edge", "s")
        length = sums.groupBy(*keys).agg(F.max("length").alias("length"))
        beyond = found.where("target IS NULL").join(length, list(keys)).withColumn(side, F.lit(0.0) if left else (F.col("length") - 1).cast("double")).drop("length")
        filled = met.unionByName(beyond).withColumn("height", F.col("peak_height")).select(*open_.columns)
        open_ = open_.where(F.col(side).isNotNull()).unionByName(filled)
    return open_


def _areas(wide: DataFrame, blocks: DataFrame, sums: DataFrame, block: int, resolution: int, keys: tuple[str, ...]) -> DataFrame:
    """area of peaks (keys, bin, a, b: bins, the second exclusive) over several blocks: what lies in the blocks of both ends, and the sums of those between."""
    along = Window.partitionBy(*keys).orderBy("block_idx").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*keys, "block_idx", F.coalesce(F.sum("total").over(along), F.lit(0.0)).alias("before"), "total")  # a row a block
    first, last = F.floor(F.col("a") / block), F.floor((F.col("b") - 1) / block)
    ends = wide.withColumn("block_idx", F.explode(F.array_distinct(F.array(first, last))))
    met = ends.join(blocks.select(*keys, "block_idx", "values"), [*keys, "block_idx"]).join(before, [*keys, "block_idx"])
    low = F.greatest(F.col("a") - F.col("block_idx") * block, F.lit(0)).cast("int")
    high = F.least(F.col("b") - F.col("block_idx") * block, F.size("values").cast("long")).cast("int")
    part = F.aggregate(F.slice("values", low + 1, high - low), F.lit(0.0), lambda t, v: t + v)
    one = lambda at: F.when(F.floor(at / block) == F.col("block_idx"), F.get("values", (at - F.col("block_idx") * block).cast("int")))
    between = F.when(F.col("block_idx") == last, F.col("before")).otherwise(-F.col("before") - F.col("total"))  # sums of whole blocks: before the last, less up to the first
    pieces = met.select(*keys, "bin", part.alias("part"), F.when(first < last, between).otherwise(0.0).alias("between"), one(F.col("a")).alias("x"), one(F.col("b") - 1).alias("y"))
    total = F.sum("part") + F.sum("between") - (F.max("x") + F.max("y")) / 2
    return pieces.groupBy(*keys, "bin").agg((total * resolution).alias("area"))


def call_peaks(
    blocks: DataFrame, resolution: int, distance_bp: int, thresholds: DataFrame, block: int = B.BLOCK, keys: tuple[str, ...] = ("chrom", "track"), rel_height: float = 0.5, least_width: int = 2, fan: int = FAN
) -> DataFrame:
    """Peaks of every track: keys, start, end, summit (base pairs), auc, signal_value, prominence.

    blocks: dense values of a stored table; thresholds: keys, min_prominence (tracks without one have no peaks).  Peaks nearer than distance_bp to a higher one go first, then those of a
    prominence below the threshold, then those narrower than least_width bins at rel_height of their prominence.
    """
    sums, last = summaries(blocks, block, keys)
    tree = Hierarchy(sums, last, keys, fan)
    kept = suppress(written(maxima(sums, block, keys), "maxima"), math.ceil(distance_bp / resolution), block, keys)
    tall = prominences(kept, sums, tree, keys).join(thresholds.select(*keys, "min_prominence"), list(keys)).where("prominence >= min_prominence").drop("min_prominence")
    found, n_open = written_noting(_in_blocks(blocks, tall, block, resolution, rel_height, keys), "widths", F.sum(F.col("area").isNull().cast("long")))
    a = F.floor("left")
    within = lambda rows: rows.where(F.col("right") - F.col("left") >= least_width).withColumns({"a": a, "b": F.greatest(F.ceil("right"), a + 1)})
    out = within(found.where("area IS NOT NULL"))
    if n_open:
        rest = written(within(_ends(found.where("area IS NULL"), sums, tree, block, rel_height, keys)).drop("area"), "ends")
        out = out.unionByName(rest.join(_areas(rest, blocks, sums, block, resolution, keys), [*keys, "bin"]))
    bp = lambda c: (F.col(c) * resolution).cast("long")
    return out.select(*keys, bp("a").alias("start"), bp("b").alias("end"), bp("bin").alias("summit"), F.col("area").alias("auc"), F.col("height").alias("signal_value"), "prominence")
