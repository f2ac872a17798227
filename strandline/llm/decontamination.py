"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are runs of lower-cased tokens (letters, digits and all characters outside ASCII).
Documents join the items on shared seeds of ``min_match`` tokens.  For each pair that shares one, the tiles are found as
in running Karp-Rabin: rolling fingerprints give the matching places, each grown to a maximal match, and the longest
match of tokens not yet marked on either side is marked again and again until none of min_match tokens is left.  Tiles
may come in any order, so reordered passages count.  A document is contaminated if the tiles cover enough of an item.
Of the maximal matches of one span of an item, n tokens of its L, only the first n * L + 1 in the document are looked at.  All tiles together mark
L tokens of the document at most, each within n of these matches at most, so one of them is never touched; at any time what is free of it holds what is free of
any later one, and lies before it, so no later one is ever marked.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import kernels as K
from strandline.llm.common import map_texts, numbered, written

MIN_MATCH = 5
#: Share of an item's tokens that tiles must cover.
COVERAGE = 0.5
#: Bytes of benchmark text whose seeds one pass over the documents holds; a larger benchmark takes more passes.
BLOCK_BYTES = 32 << 20
#: Shared seeds of documents and items that are looked at together.
HITS = 1 << 20


def greedy_tiles(matches: list[tuple[int, int, int]], length: int, min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (place in doc, place in item, length) from all maximal matches with an item of that length: the longest first; ties: the earliest in the
    document, then in the item."""
    heap = [(-n, p, q) for p, q, n in matches]
    heapq.heapify(heap)
    doc_marked, item_marked, tiles = set(), bytearray(length), []
    room = b"\0" * min_match
    while heap and room in item_marked:  # an unmarked run of the item is left
        n, p, q = heapq.heappop(heap)
        free = [k for k in range(-n) if p + k not in doc_marked and not item_marked[q + k]]
        if len(free) == -n:
            tiles.append((p, q, -n))
            doc_marked.update(range(p, p - n))
            item_marked[q : q - n] = b"\1" * -n
            continue
        begin = 0
        for k in range(1, len(free) + 1):  # what is left of it, in unbroken runs
            if k == len(free) or free[k] != free[k - 1] + 1:
                if k - begin >= min_match:
                    heapq.heappush(heap, (begin - k, p + free[begin], q + free[begin]))
                begin = k
    return tiles


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token fingerprints of all texts, and each text's bounds."""
    buf, offs = K.buffer(column)
    buf = K.LOWER[buf]
    start, end, bounds = K.words(buf, offs, K.IS_ALNUM)
    return K.word_hashes(buf, start, end), bounds


class Seeds:
    """The items of a block by the fingerprints of their runs of ``size`` tokens."""

    def __init__(self, ids: list, items: list[np.ndarray], size: int):
        self.ids, self.items = ids, items
        lengths = np.array([len(x) for x in items], np.int64)
        self.lengths = lengths
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        at, keys = K.windows(np.concatenate([*items, np.empty(0, np.uint64)]), bounds, size)
        item = np.searchsorted(bounds, at, side="right") - 1
        order = np.argsort(keys, kind="stable")
        self.keys, self.item, self.place = keys[order], item[order], (at - bounds[item])[order]
        self.filter = np.zeros(1 << 22, bool)
        self.filter[(self.keys & K.U((1 << 22) - 1)).astype(np.int64)] = True

    def before(self, left: np.ndarray, right: np.ndarray, item: int) -> np.ndarray:
        """In each range of seeds of one key, where the items from ``item`` on begin."""
        low, high = left.copy(), right.copy()
        while (low < high).any():
            middle = (low + high) // 2
            less = (low < high) & (self.item[np.minimum(middle, len(self.item) - 1)] < item)
            low, high = np.where(less, middle + 1, low), np.where(less | (low >= high), high, middle)
        return low

    def hits(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the keys that are seeds, and the range of each in the sorted seeds."""
        maybe = np.flatnonzero(self.filter[(keys & K.U((1 << 22) - 1)).astype(np.int64)])
        left = np.searchsorted(self.keys, keys[maybe])
        right = np.searchsorted(self.keys, keys[maybe], side="right")
        found = right > left
        return maybe[found], left[found], right[found]


def _expanded(doc: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, block: Seeds, first: int, last: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Seeds that documents share with the items first .. last - 1 (document, item, place in document, place in item), all of a document and an item
    together, in pieces of HITS or a single pair's."""
    count = right - left
    if not len(at) or not count.sum():
        return
    if count.sum() > HITS and doc[0] != doc[-1]:
        half = int(np.searchsorted(doc, doc[np.searchsorted(np.cumsum(count), count.sum() // 2)], "right"))
        half = half if half < len(doc) else int(np.searchsorted(doc, doc[-1]))
        yield from _expanded(doc[:half], at[:half], left[:half], right[:half], block, first, last)
        yield from _expanded(doc[half:], at[half:], left[half:], right[half:], block, first, last)
        return
    if count.sum() > HITS and last - first > 1:  # a key's items ascend, so each half of the items is a part of its range
        middle = (first + last) // 2
        cut = block.before(left, right, middle)
        yield from _expanded(doc, at, left, cut, block, first, middle)
        yield from _expanded(doc, at, cut, right, block, middle, last)
        return
    seed = K.runs(left, count)
    yield np.repeat(doc, count), block.item[seed], np.repeat(at, count), block.place[seed]


def maximal_matches(doc: np.ndarray, item: np.ndarray, p: np.ndarray, q: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """From all shared seeds of ``size`` tokens: document, item, place in each, length, of the maximal matches that can matter, by document and item.

    The seeds of a match follow each other on its diagonal."""
    order = np.lexsort((p, p - q, item, doc))
    doc, item, p, q = doc[order], item[order], p[order], q[order]
    new = np.ones(len(p), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (p[1:] != p[:-1] + 1) | (q[1:] != q[:-1] + 1)
    head = np.flatnonzero(new)
    n = np.diff(np.append(head, len(p))) + size - 1
    doc, item, p, q = doc[head], item[head], p[head], q[head]
    order = np.lexsort((p, n, q, item, doc))
    doc, item, p, q, n = doc[order], item[order], p[order], q[order], n[order]
    other = np.ones(len(p), bool)
    other[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (q[1:] != q[:-1]) | (n[1:] != n[:-1])
    nth = np.arange(len(p)) - np.maximum.accumulate(np.where(other, np.arange(len(p)), 0))
    kept = nth <= n * lengths[item]
    return doc[kept], item[kept], p[kept], q[kept], n[kept]


def _scan(seeds, min_match: int, coverage: float):
    names = ["row", "doc_id", "n_items", "n_shared", "best_item", "best_tiled", "best_coverage"]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        block = seeds.value
        hashes, bounds = tokens(batch.column("text"))
        at, keys = K.windows(hashes, bounds, min_match)
        hit, left, right = block.hits(keys)
        at = at[hit]
        doc = np.searchsorted(bounds, at, side="right") - 1
        best: dict[int, list] = {}
        for piece in _expanded(doc, at, left, right, block, 0, len(block.items)):
            found = maximal_matches(*piece, block.lengths, min_match)
            d_, i_ = found[0], found[1]
            heads = np.flatnonzero(np.concatenate(([True], (d_[1:] != d_[:-1]) | (i_[1:] != i_[:-1]))))
            for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(d_)]):
                d, i = int(d_[a]), int(i_[a])
                size = int(block.lengths[i])
                tiled = sum(n for _, _, n in greedy_tiles(list(zip(*(x[a:b].tolist() for x in found[2:]))), size, min_match))
                row = best.setdefault(d, [0, 0, None, 0, 0.0])
                share = tiled / size
                row[0] += share >= coverage
                row[1] += 1
                if row[2] is None or (share, -block.ids[i]) > (row[4], -row[2]):
                    row[2:] = [block.ids[i], tiled, share]
        rows = [best.get(d, [0, 0, None, 0, 0.0]) for d in range(batch.num_rows)]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types))], names=names)

    return step


def tile_benchmark(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row of docs (doc_id, text) against all of benchmark (item_id, text).

    Returns doc_id, n_shared (items that share a seed), n_items (those covered enough), best_item (the most covered, then the
    smallest id), best_tiled (its tokens in tiles), best_coverage, kept (no item is covered enough).  Null or empty texts
    share nothing; long texts are tiled whole (a text must fit a task's memory some 60 times over); an item of fewer than min_match tokens cannot be found; repeated items count each; null item ids are left
    out; an empty benchmark keeps every row; an empty table gives no rows.  Nothing is shuffled for a benchmark of one block
    of block_bytes; for a larger one, each block of items takes a pass over
    the numbered rows, one after the other, and the passes are merged by row; repeated rows and null ids come back each.
    """
    spark = docs.sparkSession
    items = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    rows = docs.select("doc_id", "text")
    rows = numbered(rows, "rows") if n_blocks > 1 else rows.withColumn("row", F.lit(0).cast("long"))
    schema = "row long, doc_id long, n_items long, n_shared long, best_item long, best_tiled long, best_coverage double"
    scans = []
    for k in range(n_blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k).orderBy("item_id", "text").toArrow()
        hashes, bounds = tokens(mine.column("text"))
        found = [(i, hashes[a:b]) for i, a, b in zip(mine.column("item_id").to_pylist(), bounds[:-1], bounds[1:]) if b - a >= min_match]
        seeds = spark.sparkContext.broadcast(Seeds([i for i, _ in found], [x for _, x in found], min_match))  # at most block_bytes of text
        scan = map_texts(rows.select("row", "doc_id", "text"), _scan(seeds, min_match, coverage), schema)
        if n_blocks > 1:  # one block at a time stands on the driver and in the tasks
            scan = written(scan, "scan")
            seeds.destroy()
        scans.append(scan)
    out = scans[0]
    if n_blocks > 1:
        best = F.max(F.struct("best_coverage", (-F.col("best_item")).alias("i"), "best_tiled"))
        out = reduce(DataFrame.unionByName, scans).groupBy("row", "doc_id").agg(F.sum("n_items").alias("n_items"), F.sum("n_shared").alias("n_shared"), best.alias("b"))
        out = out.select("doc_id", "n_items", "n_shared", (-F.col("b.i")).alias("best_item"), "b.best_tiled", "b.best_coverage")
    return out.select("doc_id", "n_shared", "n_items", "best_item", "best_tiled", "best_coverage", (F.col("n_items") == 0).alias("kept"))
