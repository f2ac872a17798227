"""Near duplicates by MinHash bands and sequential Bayesian verification.

Documents with the same shingles form a class.  Classes that share a band of their MinHash signatures are candidates.  Their
signatures are compared batch by batch: after each batch the posterior of the similarity (uniform prior) is known, and a
pair goes as soon as the probability that it reaches the threshold is below the chosen miss probability.  Survivors are verified on
their full sets.

Links matter only through the components they make.  So each bucket first offers, for each member, its likeliest partners; in a large bucket
those among some two thousand members.  What these links leave apart is settled in a second round: survivors from different components, all of
them, in small buckets as pairs, in large ones within the task that holds (a block pair of) the bucket, likeliest first and skipping what has
been joined meanwhile.  Members of the bucket's largest component are not compared with each other again.  No large bucket's pairs are
ever emitted, and no link between components is left untested.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm import kernels as K
from strandline.llm.common import map_texts, written
from strandline.llm.components import connected_components

SHINGLE = 3
#: Similarity (intersection over union) that links, as a ratio of integers.
LINK = (85, 100)
BANDS = 25
ROWS = 5
#: Hashes of a signature (the first BANDS * ROWS make the bands; comparison takes 8 bits of each), and of a batch.
HASHES = 400
BATCH = 50
MISS = 1e-5
#: Members of a bucket that one comparison step holds; a larger bucket is compared block by block.
BLOCK = 1000
#: Partners that each member tests in the first round.
PARTNERS = 2
#: Members of the largest bucket whose pairs are emitted in the second round.
SMALL = 32
#: Documents whose ids are broadcast to pick out candidates' texts; beyond, ids and texts are joined by shuffling.
BROADCAST_IDS = 2_000_000

_rng = np.random.Generator(np.random.PCG64(7))
_A = _rng.integers(1, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle fingerprints of each text, sorted, and each text's bounds; a text shorter than a shingle has itself."""
    buf, offs = K.buffer(column)
    buf = K.LOWER[buf]
    start, end, bounds = K.words(buf, offs)
    hashes = K.word_hashes(buf, start, end)
    n_words = np.diff(bounds)
    at, keys = K.windows(hashes, bounds, size)
    doc = np.searchsorted(bounds, at, side="right") - 1
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    whole = K.span(K.prefix(hashes), bounds[short], bounds[short + 1])
    keys, doc = np.concatenate((keys, whole)), np.concatenate((doc, short))
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    keys, doc = keys[new], doc[new]
    return keys, np.searchsorted(doc, np.arange(len(offs)))


def signatures(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash signatures of the non-empty sets, a row a set."""
    heads = bounds[:-1][np.diff(bounds) > 0]
    x = (K.mix(keys) >> K.U(32)).astype(np.uint32)
    out = np.empty((len(heads), HASHES), np.uint32)
    for k in range(HASHES):
        if len(heads):
            out[:, k] = np.minimum.reduceat(x * _A[k] + _B[k], heads)
    return out


def least_matches(similarity: float, miss: float = MISS) -> list[int]:
    """For each further batch, the fewest matches so far that keep a pair: P(similarity reached | matches) >= miss."""
    t, out = Fraction(similarity).limit_denominator(1000), []
    for n in range(BATCH, HASHES + 1, BATCH):
        m = 0
        while m < n:  # 1 - I_t(m + 1, n - m + 1), the upper tail of the posterior
            below = sum(comb(n + 1, j) * float(t) ** j * float(1 - t) ** (n + 1 - j) for j in range(m + 1))
            if below >= miss:
                break
            m += 1
        out.append(m)
    return out


def surviving(a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (rows left[i] of a, right[i] of b) that no batch prunes, and their numbers of matches."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int32)
    for k, need in enumerate(least):
        cols = slice(k * BATCH, (k + 1) * BATCH)
        for part in range(0, len(alive), 200_000):
            rows = alive[part : part + 200_000]
            matches[rows] += (a[left[rows], cols] == b[right[rows], cols]).sum(1, dtype=np.int32)
        alive = alive[matches[alive] >= need]
    return alive, matches[alive]


def _describe(size: int):
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, bounds = shingle_sets(batch.column("text"), size)
        n = np.diff(bounds)
        full = np.flatnonzero(n > 0)
        sig = signatures(keys, bounds)
        bands = K.span(K.prefix(sig[:, : BANDS * ROWS].ravel().astype(np.uint64)), (at := np.arange(0, len(full) * BANDS * ROWS, ROWS)), at + ROWS)
        bands = K.mix(bands.reshape(-1, BANDS) + np.arange(BANDS, dtype=np.uint64))
        short = sig.astype(np.uint8)
        sigs, slots = [None] * len(n), [None] * len(n)
        for k, d in enumerate(full.tolist()):
            sigs[d], slots[d] = short[k].tobytes(), bands[k].view(np.int64)
        columns = [batch.column("doc_id"), pa.array(n), pa.array(set_names(keys, bounds)), pa.array(sigs, pa.binary()), pa.array(slots, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "node", "sig", "bands"])

    return step


def set_names(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set, 0 for an empty one."""
    n = np.diff(bounds)
    full = n > 0
    out = np.zeros(len(n), np.uint64)
    if full.any():
        out[full] = K.mix(np.add.reduceat(K.mix(keys), bounds[:-1][full]) + n[full].astype(np.uint64))
    return out.view(np.int64)


def _set_rows(size: int):
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, bounds = shingle_sets(batch.column("text"), size)
        full = np.flatnonzero(np.diff(bounds) > 0)
        sets = [keys[bounds[r] : bounds[r + 1]].tobytes() for r in full]
        return pa.RecordBatch.from_arrays([pa.array(set_names(keys, bounds)[full]), pa.array(sets, pa.binary())], names=["node", "members"])

    return step


def linked(x: np.ndarray, y: np.ndarray, link: tuple[int, int]) -> bool:
    """Whether two sorted sets reach the similarity."""
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return link[1] * common >= link[0] * (len(both) - common)


def verified(pairs: DataFrame, sets: DataFrame, link: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), link) for x, y in zip(batch.column("set_a"), batch.column("set_b"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    full = lambda c: sets.select(F.col("node").alias(c), F.col("members").alias(f"set_{c}"))
    return pairs.join(full("a"), "a").join(full("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


class Bucket:
    """Rows of some buckets, by (key, i, j); a bucket of one block has i = j = 0."""

    NUMBERS = ("key", "band", "i", "j", "block", "node", "component")

    def __init__(self, batch: pa.RecordBatch, with_sets: bool):
        self.columns = {c: batch.column(c).to_numpy() for c in self.NUMBERS}
        self.columns["sig"] = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(-1, HASHES)
        self.columns["bands"] = batch.column("bands").flatten().to_numpy().reshape(-1, BANDS)
        if with_sets:
            sets = np.empty(batch.num_rows, object)
            sets[:] = batch.column("members").to_pylist()
            self.columns["members"] = sets

    def bounds(self) -> list[int]:
        k, i, j = (self.columns[c] for c in ("key", "i", "j"))
        cut = np.flatnonzero((k[1:] != k[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        return [0, *cut.tolist(), len(k)]

    def candidates(self, bounds: list[int], least: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of different components that survive, each in the first band that it shares, and their matches."""
        c, left, right = self.columns, [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for s, e in zip(bounds, bounds[1:]):
            if e - s > 1:
                x, y = np.triu_indices(e - s, 1)
                left.append(x + s)
                right.append(y + s)
        left, right = np.concatenate(left), np.concatenate(right)
        ok = (c["component"][left] != c["component"][right]) & ((c["i"][left] == c["j"][left]) | (c["block"][left] != c["block"][right]))
        left, right = left[ok], right[ok]
        alive, matches = surviving(c["sig"], c["sig"], left, right, least)
        left, right = left[alive], right[alive]
        first = np.concatenate([np.argmax(c["bands"][left[k : k + 100_000]] == c["bands"][right[k : k + 100_000]], axis=1) for k in range(0, len(left), 100_000)] or [np.empty(0, np.int64)])
        ok = first == c["band"][left]
        return left[ok], right[ok], matches[ok]


def by_bucket(work, similarity: float, with_sets: bool = False):
    """A mapInArrow function over rows in the order of (key, i, j): work(bucket, bounds, least) gives pairs (a, b)."""
    least = least_matches(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in _with_end(batches):
            if batch is not None:
                new = Bucket(batch, with_sets)
                if held is not None:
                    new.columns = {c: np.concatenate((held.columns[c], new.columns[c])) for c in new.columns}
                held = new
            if held is None or not len(held.columns["key"]):
                continue
            bounds = held.bounds()
            if batch is not None:  # the last group may go on
                bounds.pop()
            at = 0
            while at < len(bounds) - 1:  # groups of some two million pairs together
                to, pairs = at, 0
                while to < len(bounds) - 1 and (to == at or pairs < 1_000_000):
                    pairs += (bounds[to + 1] - bounds[to]) ** 2 // 2
                    to += 1
                a, b = work(held, bounds[at : to + 1], least)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
                at = to
            held.columns = {c: v[bounds[-1] :] for c, v in held.columns.items()}

    return run


def _with_end(batches):
    yield from batches
    yield None


def likeliest(most: int):
    """For each member of a bucket, its pairs of the most matches (ties: the smaller partner)."""

    def work(bucket: Bucket, bounds: list[int], least: list[int]) -> tuple[np.ndarray, np.ndarray]:
        left, right, matches = bucket.candidates(bounds, least)
        node = bucket.columns["node"]
        ends, other, score = np.concatenate((left, right)), np.concatenate((right, left)), np.tile(matches, 2)
        order = np.lexsort((node[other], -score, ends))
        rank = np.empty(len(ends), np.int64)
        rank[order] = np.arange(len(order)) - np.searchsorted(ends[order], ends[order])
        pick = (rank[: len(left)] < most) | (rank[len(left) :] < most)
        return node[left[pick]], node[right[pick]]

    return work


def every(bucket: Bucket, bounds: list[int], least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    left, right, _ = bucket.candidates(bounds, least)
    return bucket.columns["node"][left], bucket.columns["node"][right]


def joining(link: tuple[int, int]):
    """The verified links that join components within a bucket: likeliest pairs first, those already joined skipped."""

    def work(bucket: Bucket, bounds: list[int], least: list[int]) -> tuple[np.ndarray, np.ndarray]:
        left, right, matches = bucket.candidates(bounds, least)
        node, comp, sets = (bucket.columns[c] for c in ("node", "component", "members"))
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        a, b = [], []
        for k in np.argsort(-matches, kind="stable").tolist():
            x, y = int(left[k]), int(right[k])
            p, q = root(int(comp[x])), root(int(comp[y]))
            if p != q and linked(np.frombuffer(sets[x], np.uint64), np.frombuffer(sets[y], np.uint64), link):
                parent[max(p, q)] = min(p, q)
                a.append(node[x])
                b.append(node[y])
        return np.array(a, np.int64), np.array(b, np.int64)

    return work


def _dealt(rows: DataFrame, partners: Column) -> DataFrame:
    """Rows with a block for each of the pairs (i, j) of their block and its partners, ready for by_bucket."""
    rows = rows.withColumn("with", F.explode(partners))
    rows = rows.withColumn("i", F.least("block", "with")).withColumn("j", F.greatest("block", "with")).select("key", "band", "i", "j", "block", "node", "component", *(c for c in ("sig", "bands", "members") if c in rows.columns))
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def in_near_blocks(rows: DataFrame) -> DataFrame:
    """Bucket rows (key, n_members, node, ...) in blocks, each beside itself and the next one: copies don't grow with the bucket."""
    n_blocks = F.ceil(F.col("n_members") / BLOCK).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), n_blocks).cast("int"))
    return _dealt(rows, F.array_distinct(F.array("block", F.pmod(F.col("block") + 1, n_blocks))))


def in_split_blocks(rows: DataFrame) -> DataFrame:
    """Bucket rows in blocks, those of the bucket's largest component apart (n_main of them): every pair of blocks but those within that
    component, whose members are joined already.  A large group of near copies that the first round has joined costs little."""
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    main, rest = blocks(F.col("n_main")), blocks(F.col("n_members") - F.col("n_main"))
    own = F.col("component") == F.col("main")
    rows = rows.withColumn("block", F.when(own, F.pmod(F.xxhash64("node"), main)).otherwise(main + F.pmod(F.xxhash64("node"), F.greatest(rest, F.lit(1)))).cast("int"))
    return _dealt(rows, F.sequence(F.when(own, main).otherwise(F.lit(0)), main + rest - 1))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, link: tuple[int, int] = LINK) -> DataFrame:
    """Every row of docs (doc_id, text) with its component: doc_id, n_shingles, component_id, kept.

    A document's set are its distinct shingles of ``size`` lower-cased words (A-Z); with fewer words, the whole sequence as one.
    Documents whose sets reach link[0] / link[1] are linked; component_id is the smallest doc_id that can be reached and kept
    says whether it is the document itself.  Null or blank texts have no shingles and link with nothing.  Of rows that share a
    doc_id, each is a document; null ids link, but name a component only where it has no other id.  An empty
    table gives no rows; other columns are ignored.  Sets are compared as 64-bit fingerprints of shingles; a long text's set is held whole, so it must
    fit a task's memory some 60 times over.  Equal texts, however many, are one class; ties between partners go to the smaller.
    """
    similarity = link[0] / link[1]
    schema = "doc_id long, n_shingles long, node long, sig binary, bands array<long>"
    described = written(map_texts(docs.select("doc_id", "text"), _describe(size), schema), "described")
    classes = described.where("n_shingles > 0").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "sig", "bands")).alias("c"))
    classes = written(classes.select("node", "c.doc_id", "c.sig", "c.bands"), "classes")

    slots = classes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = slots.groupBy("key").agg(F.count("*").alias("n_members")).where("n_members > 1")
    buckets = written(slots.join(shared, "key"), "buckets")

    wanted = written(classes.join(buckets.select("node").distinct(), "node", "left_semi").select(F.col("doc_id").alias("wanted_id")).distinct(), "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
    sets = written(map_texts(texts, _set_rows(size), "node long, members binary").dropDuplicates(["node"]), "sets")

    marks = classes.select("node", "sig", "bands")
    first = in_near_blocks(buckets.withColumn("component", F.col("node")).join(marks, "node"))
    pairs = first.mapInArrow(by_bucket(likeliest(PARTNERS), similarity), "a long, b long")
    links = verified(pairs, sets, link)
    labels = written(connected_components(links), "labels")

    labelled = buckets.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = labelled.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("m"), F.count("*").alias("n_parts")).where("n_parts > 1")
    rest = written(labelled.join(mixed.select("key", F.col("m.n").alias("n_main"), F.col("m.component").alias("main")), "key"), "rest")
    small = in_near_blocks(rest.where(F.col("n_members") <= SMALL).join(marks, "node")).mapInArrow(by_bucket(every, similarity), "a long, b long")
    large = in_split_blocks(rest.where(F.col("n_members") > SMALL).join(marks, "node").join(sets, "node")).mapInArrow(by_bucket(joining(link), similarity, True), "a long, b long")
    more = verified(small, sets, link).unionByName(large)
    own = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    labels = written(connected_components(own.unionByName(more)), "labels")

    named = classes.select("node", "doc_id").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "component").select("node", "component_id")
    # the one row of a class goes to all its copies; documents without shingles have none
    out = described.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node")).join(named, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
