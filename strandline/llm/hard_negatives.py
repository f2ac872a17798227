"""Hard negatives by an R-tree packed by sort-tile-recursive.

Vectors of one label are tiled by their coordinates of largest variance into parts of a bounded size; in a part, the same tiling goes on down to
pages, and boxes (least and greatest coordinates) are packed over pages, level by level.  A box bounds the inner product with any anchor
from both sides, coordinate by coordinate.  A search pops the box with the highest bound from a queue; it leaves out boxes that lie outside
every score window and those strictly below the worst of the best scores found so far, and ends when no box is left that could matter.

Parts are tasks' units: anchors are sent to the parts whose boxes matter to them, and stream by the part's tree.  A first search in the most
promising part gives each anchor a floor; so the second one, over all parts, sends and returns little.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import numbered, ranked, written

#: Anchors, positives and negatives of each, and the window of a negative's score (hundredths of it, in multiples of the positive's).
ANCHORS = 100
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
#: Components are floor(SCALE * x), and no further from 0 than LIMIT.
SCALE = 256
LIMIT = 1 << 24
#: Rows of a part, vectors of a page, boxes of a box.
PART_ROWS = 1 << 15
PAGE = 64
FAN = 16
#: Boxes that every task of the search has: of parts, or of runs of parts.
TOP = 1024
#: Anchors of one batch.
BATCH = 256
NOWHERE = -(1 << 62)


def prepared(vectors: DataFrame) -> DataFrame:
    """Rows that take part (vec_id, label, v): whole components; rows without id, label or vector, or with a component that is null or not finite, go."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    whole = F.transform(x, lambda c: F.greatest(F.least(F.floor(c * SCALE), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), whole.alias("v"))


def axes(rows: DataFrame, count: int = 8) -> list[int]:
    """The coordinates of largest variance (from the sums of each; a row a coordinate), ties to the first."""
    each = rows.select(F.posexplode("v").alias("k", "x")).groupBy("k").agg(F.var_pop("x").alias("s"))
    return [r["k"] for r in each.orderBy(F.desc("s"), "k").limit(count).collect()]


def tiled(rows: DataFrame, by: list[int], part_rows: int = PART_ROWS) -> DataFrame:
    """Adds part: at most part_rows rows of one label, by slabs along the first axis and tiles along the second within each.

    Rows at one place are parted by their numbers, so a part is never larger.
    """
    axis = lambda k: F.coalesce(F.get("v", F.lit(by[k] if k < len(by) else 0)), F.lit(0))
    first = ranked(rows.withColumns({"tree": F.col("label").cast("string"), "a": axis(0)}), "tree", ["a", "vec_id", "row"], "slabs")
    wide = F.ceil(F.sqrt(F.ceil(F.col("n") / part_rows))) * part_rows  # of a slab: as many tiles as there are slabs
    first = first.withColumn("tree", F.concat_ws(":", "tree", F.floor(F.col("idx") / wide).cast("string"))).drop("idx", "n", "a")
    second = ranked(first.withColumn("a", axis(1)), "tree", ["a", "vec_id", "row"], "tiles")
    return second.withColumn("part", F.concat_ws(":", "tree", F.floor(F.col("idx") / part_rows).cast("string"))).drop("tree", "a", "idx", "n")


def _tile(v: np.ndarray, order: np.ndarray, by: list[int], page: int) -> np.ndarray:
    """order, rearranged so that runs of a page are near each other: slabs along the first axis, tiled by the others."""
    pages = -(-len(order) // page)
    if pages <= 1 or not by:
        return order
    order = order[np.argsort(v[order, by[0]], kind="stable")]
    if len(by) == 1:
        return order
    slab = -(-pages // math.ceil(pages ** (1 / len(by)))) * page
    return np.concatenate([_tile(v, order[k : k + slab], by[1:], page) for k in range(0, len(order), slab)])


class Tree:
    """An R-tree of one part: rows in the order of pages; levels of boxes, the lowest (pages) first."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, v: np.ndarray, by: list[int], page: int = PAGE, fan: int = FAN):
        order = _tile(v, np.lexsort((rows, ids)), [k for k in by if k < v.shape[1]][: max(1, math.ceil(math.log2(max(2, len(v) / page)) / 2))], page)
        self.ids, self.rows, self.v, self.page, self.fan = ids[order], rows[order], v[order], page, fan
        starts = np.arange(0, len(v), page)
        low, high = np.minimum.reduceat(self.v, starts, axis=0), np.maximum.reduceat(self.v, starts, axis=0)
        least = np.minimum.reduceat(self.ids, starts)
        self.levels, self.least = [(low, high)], [least.tolist()]
        while len(low) > 1:
            starts = np.arange(0, len(low), fan)
            low, high, least = np.minimum.reduceat(low, starts, axis=0), np.maximum.reduceat(high, starts, axis=0), np.minimum.reduceat(least, starts)
            self.levels.append((low, high))
            self.least.append(least.tolist())

    def bounds(self, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each level, the least and greatest inner product of each anchor (rows) with what a box holds."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return [(up @ low.T + down @ high.T, up @ high.T + down @ low.T) for low, high in self.levels]

    def search(self, q: np.ndarray, bounds: list[tuple[np.ndarray, np.ndarray]], windows: list[tuple[int, int]], floors: list[int], k: int, but: int) -> list[list[tuple[int, int, int]]]:
        """For each window (least and greatest score) the best k rows within (score, -id, -row), highest first; floors: scores below don't matter.
        but: a row to leave out."""
        best: list[list] = [[] for _ in windows]
        floor = [max(low, f) for (low, _), f in zip(windows, floors)]
        top = len(self.levels) - 1
        queue = [(-bounds[top][1][0], self.least[top][0], top, 0)]
        while queue:
            high, least, level, box = heapq.heappop(queue)
            high = -high
            if high < min(floor):
                break
            low = bounds[level][0][box]
            # at the floor itself, only a smaller id than that of the last of k counts
            late = lambda w: high == floor[w] and len(best[w]) == k and best[w][0][0] == floor[w] and least > -best[w][0][1]  # noqa: B023, E731
            open_ = [w for w, (_, most) in enumerate(windows) if low <= most and high >= floor[w] and not late(w)]
            if not open_:
                continue
            if level:
                a, b = box * self.fan, min((box + 1) * self.fan, len(self.least[level - 1]))
                for c, h in zip(range(a, b), bounds[level - 1][1][a:b].tolist()):
                    heapq.heappush(queue, (-h, self.least[level - 1][c], level - 1, c))
                continue
            a, b = box * self.page, min((box + 1) * self.page, len(self.v))
            scores = self.v[a:b] @ q
            for w in open_:
                heap = best[w]
                fits = (scores >= floor[w]) & (scores <= windows[w][1])
                if len(heap) == k and heap[0][0] == floor[w]:
                    fits &= (scores > floor[w]) | (self.ids[a:b] <= -heap[0][1])
                for at in np.flatnonzero(fits).tolist():
                    if self.rows[a + at] == but:
                        continue
                    entry = (int(scores[at]), -int(self.ids[a + at]), -int(self.rows[a + at]))
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                if len(heap) == k:
                    floor[w] = max(floor[w], heap[0][0])
        return [sorted(heap, reverse=True) for heap in best]


def part_boxes(tiles: DataFrame) -> DataFrame:
    """One row a part: label, part, low, high (the ends of its box), n."""

    def one(key: tuple, table: pa.Table) -> pa.Table:
        v = _matrix(table.column("v"))
        return pa.table({"label": [table.column("label")[0].as_py()], "part": [key[0].as_py()], "low": [v.min(0).tolist()], "high": [v.max(0).tolist()], "n": [len(v)]},
                        schema=pa.schema([("label", pa.int64()), ("part", pa.string()), ("low", pa.list_(pa.int32())), ("high", pa.list_(pa.int32())), ("n", pa.int64())]))

    return tiles.groupBy("part").applyInArrow(one, "label long, part string, low array<int>, high array<int>, n long")


def _matrix(column: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    out = np.zeros((len(column), max(width, int(sizes.max(initial=1)))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _fit(a: np.ndarray, width: int) -> np.ndarray:
    """a with so many columns: zeros are added, columns beyond meet only zeros of the other side."""
    return a[:, :width] if a.shape[1] >= width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def _numbers(v: np.ndarray, q: np.ndarray) -> type:
    """Doubles where every sum is exact in them, else 64-bit whole numbers."""
    return np.float64 if int(np.abs(v).max(initial=0)) * int(np.abs(q).max(initial=0)) * v.shape[1] < 1 << 53 else np.int64


#: What is sent to a part (kind 1), beside the part's own rows (kind 0); a window has its positive's number, ends and floor.
_MESSAGE = "part string, kind int, row long, id long, label long, v array<int>, place array<long>, low array<long>, high array<long>, floor array<long>"
FOUND = "anchor long, anchor_id long, place long, row long, id long, score long"


def _search(tiles: DataFrame, asked: DataFrame, by: list[int], k: int) -> DataFrame:
    """Best k rows of each part for each window of the anchors sent to it (part, row, id, v, place, low, high, floor): FOUND.

    A part's rows come first, then the anchors in batches: a task holds one part and one batch.
    """
    none = [F.lit(None).cast("array<long>").alias(c) for c in ("place", "low", "high", "floor")]
    own = tiles.select("part", F.lit(0).alias("kind"), "row", F.col("vec_id").alias("id"), "v", *none)
    sent = asked.select("part", F.lit(1).alias("kind"), "row", "id", "v", "place", "low", "high", "floor")
    rows = own.unionByName(sent).repartition("part").sortWithinPartitions("part", "kind")

    def answer(tree: Tree, batch: pa.RecordBatch) -> pa.RecordBatch:
        width = tree.v.shape[1]
        q = _fit(_matrix(batch.column("v")), width)
        number = _numbers(tree.v, q)
        if tree.v.dtype != number:
            tree.v, tree.levels = tree.v.astype(number), [(a.astype(number), b.astype(number)) for a, b in tree.levels]
        q = q.astype(number)
        bounds = tree.bounds(q)
        out: list[tuple] = []
        for i, (row, id_, place, low, high, floor) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("row", "id", "place", "low", "high", "floor")))):
            found = tree.search(q[i], [(a[i], b[i]) for a, b in bounds], list(zip(low, high)), floor, k, row)
            out += [(row, id_, p, -r, -n, s) for p, best in zip(place, found) for s, n, r in best]
        names = [c.split()[0] for c in FOUND.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(len(names))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, tree = None, [], None
        for batch in batches:
            parts = batch.column("part").to_pylist()
            kinds = batch.column("kind").to_numpy()
            cuts = [0, *(i for i in range(1, len(parts)) if parts[i] != parts[i - 1] or kinds[i] != kinds[i - 1]), len(parts)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if parts[a] != part:
                    part, held, tree = parts[a], [], None
                if kinds[a] == 0:
                    held.append(batch.slice(a, b - a))
                    continue
                if tree is None:
                    whole = pa.Table.from_batches(held)
                    tree, held = Tree(whole.column("id").to_numpy(), whole.column("row").to_numpy(), _matrix(whole.column("v")), by), []
                for at in range(a, b, BATCH):
                    yield answer(tree, batch.slice(at, min(BATCH, b - at)))

    return rows.mapInArrow(run, FOUND)


def _sent(anchors: DataFrame, boxes: DataFrame, same: bool, home: bool) -> DataFrame:
    """Anchors (row, id, label, v, place, low, high, floor), once for each part that they are sent to.

    same: to parts of their own label, else to the others.  home: to the part with the highest bound alone; else to all whose box
    reaches a floor and lies no higher than the end of its window.  Boxes of TOP parts at most go to every task; where there are more parts,
    those of TOP runs of neighbours do, and a run stands for its parts.
    """
    n = max(1, boxes.count())
    run = -(-n // TOP)
    if run == 1:
        placed = boxes.withColumn("run", (F.row_number().over(Window.orderBy("label", "part")) - 1).cast("int"))  # TOP rows at most
    else:
        placed = ranked(boxes.select("label", "part", "low", "high", F.lit("").alias("tree")), "tree", ["label", "part"], "boxes").withColumn("run", F.floor(F.col("idx") / run).cast("int"))
    labels = placed.groupBy("run").agg(F.min("label").alias("first"), F.max("label").alias("last"), F.count("*").alias("parts"))
    each = placed.select("run", F.posexplode(F.arrays_zip("low", "high")).alias("k", "x")).groupBy("run", "k").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high"), F.count("*").alias("have"))
    short = lambda c, f: F.when(F.col("have") < F.col("parts"), f(c, F.lit(0))).otherwise(F.col(c)).alias(c)  # noqa: E731  (a coordinate that some lack is 0 there)
    ends = each.join(labels, "run").groupBy("run", "first", "last").agg(F.array_sort(F.collect_list(F.struct("k", short("low", F.least), short("high", F.greatest)))).alias("x"))
    runs = ends.select("run", "first", "last", F.transform("x", lambda e: e["low"]).alias("low"), F.transform("x", lambda e: e["high"]).alias("high")).orderBy("run").toArrow()
    low, high = _matrix(runs.column("low")), _matrix(runs.column("high"))
    shared = boxes.sparkSession.sparkContext.broadcast((runs.column("run").to_numpy(), runs.column("first").to_numpy(), runs.column("last").to_numpy(), low, high))  # TOP boxes at most

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, first, last, low, high = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                q = _fit(_matrix(batch.column("v")), low.shape[1])
                up, down = np.maximum(q, 0), np.minimum(q, 0)
                most, least = up @ high.T + down @ low.T, up @ low.T + down @ high.T
                label = batch.column("label").to_numpy()[:, None]
                fits = (first <= label) & (label <= last) if same else (first != label) | (last != label)
                if home:
                    best = np.where(fits, most, np.iinfo(np.int64).min).argmax(1) if len(number) else np.zeros(len(q), int)
                    chosen = [[int(b)] if len(number) and fits[i, b] else [] for i, b in enumerate(best)]
                else:
                    ends = list(zip(batch.column("low").to_pylist(), batch.column("high").to_pylist(), batch.column("floor").to_pylist()))
                    chosen = []
                    for i, windows in enumerate(ends):
                        ok = np.zeros(len(number), bool)
                        for a, b, f in zip(*windows):
                            ok |= (most[i] >= max(a, f)) & (least[i] <= b)
                        chosen.append(np.flatnonzero(ok & fits[i]).tolist())
                take = np.repeat(np.arange(len(q)), [len(c) for c in chosen])
                out = batch.take(pa.array(take))
                runs_ = pa.array([int(number[c]) for each in chosen for c in each], pa.int32())
                yield pa.RecordBatch.from_arrays([runs_, *out.columns], names=["run", *out.schema.names])

    schema = "run int, row long, id long, label long, v array<int>, place array<long>, low array<long>, high array<long>, floor array<long>"
    dealt = anchors.select("row", "id", "label", "v", "place", "low", "high", "floor").mapInArrow(deal, schema)
    parts = placed.select("run", "part", F.col("label").alias("of"))
    if home and run > 1:  # of the best run, one part that fits
        parts = parts.groupBy("run", "of").agg(F.min("part").alias("part"))
    fits = F.col("of") == F.col("label") if same else F.col("of") != F.col("label")
    out = dealt.join(parts, "run").where(fits)
    if home and run > 1:
        out = out.dropDuplicates(["row"])
    return out.drop("run", "of")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best k rows for each window of each anchor, of what parts found: FOUND and rank (from 1)."""
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _nearest(anchors: DataFrame, tiles: DataFrame, boxes: DataFrame, by: list[int], k: int, same: bool, name: str) -> DataFrame:
    """The best k rows for each window of the anchors: first in the most promising part, then, above the floor that this gives, in all."""
    near = _best(_search(tiles, _sent(anchors, boxes, same, True), by, k), k)
    floors = near.where(F.col("rank") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("known"))
    known = anchors.join(floors.withColumnRenamed("anchor", "row"), "row", "left")
    raised = F.transform(F.arrays_zip("place", "floor"), lambda p: F.greatest(p["floor"], F.coalesce(F.try_element_at("known", p["place"]), F.lit(NOWHERE))))
    asked = written(known.withColumn("floor", raised).drop("known"), f"{name}-asked")
    return _best(_search(tiles, _sent(asked, boxes, same, False), by, k), k)


def mine(vectors: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Hard negatives of embeddings (vec_id, embedding, label): anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by ANCHORS; each has its POSITIVES best other rows of its label, and for each of these the NEGATIVES
    best rows of other labels whose score lies in the window (LOW to HIGH hundredths of the positive's).  Ties go to the smaller vec_id.  Rows that lack
    an id, a label or a vector, or have a component that is null or not finite, take no part.  Repeated rows and rows that share a vec_id are rows
    each: as anchors, positives and negatives (in any order among equals).  Shorter vectors count as filled up with zeros; whole components beyond
    LIMIT count as LIMIT.  Anchors without positives, or positives without negatives, give no rows; so does an empty table.  Other columns are ignored.
    """
    rows = numbered(prepared(vectors.select("vec_id", "embedding", "label")), "vectors")
    by = axes(rows)
    tiles = written(tiled(rows, by, part_rows), "tiles")
    boxes = written(part_boxes(tiles), "boxes")
    one = lambda value: F.array(F.lit(value).cast("long"))
    anchors = tiles.where(F.col("vec_id") % ANCHORS == 0).select("row", F.col("vec_id").alias("id"), "label", "v", one(0).alias("place"), one(NOWHERE).alias("low"), one(-NOWHERE).alias("high"), one(NOWHERE).alias("floor"))
    positives = written(_nearest(anchors, tiles, boxes, by, POSITIVES, True, "positives"), "positives")
    floor = lambda x: F.expr(f"CAST(({x} - pmod({x}, 100)) / 100 AS DECIMAL(20, 0))").cast("long")  # noqa: E731  (of a hundredth, in whole numbers)
    ends = positives.withColumns({"least": -floor(f"(-{LOW} * CAST(score AS DECIMAL(20, 0)))"), "most": floor(f"({HIGH} * CAST(score AS DECIMAL(20, 0)))")})
    windows = ends.where("least <= most").groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "least", "most"))).alias("w"))  # POSITIVES at most
    asked = anchors.select("row", "id", "label", "v").join(windows.withColumnRenamed("anchor", "row"), "row")
    field = lambda c: F.transform("w", lambda x: x[c].cast("long"))
    asked = asked.select("row", "id", "label", "v", field("rank").alias("place"), field("least").alias("low"), field("most").alias("high"), F.transform("w", lambda x: F.lit(NOWHERE).cast("long")).alias("floor"))
    negatives = _nearest(written(asked, "asked"), tiles, boxes, by, NEGATIVES, False, "negatives")
    mine_ = positives.select("anchor", F.col("rank").cast("long").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = negatives.join(mine_, ["anchor", "place"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
