"""Language-model scores by context-tree weighting over bytes.

A text is its UTF-8 bytes and one end mark (255, which UTF-8 never holds).  Each byte is eight binary decisions; each decision
has a tree of contexts: the last 0, 1, ... depth bytes.  A node keeps the zeros and ones seen there and the
Krichevsky-Trofimov block probability Pe of them.  Bottom-up, Pw = 1/2 Pe + 1/2 product of the children's Pw mixes
all prunings of the tree; the prediction of a decision mixes the nodes on its path, from the deepest up to the root, with the
weights Pe / (Pe + product of the children's Pw).

The counts of a tree of depth d are those of (d + 1)-grams.  Documents are dealt to groups of some megabytes.  A group asks once for each of
its distinct grams, packed by their nearest context bytes; the buckets merge the counts.  The subtree under each two nearest bytes is then
weighted on its own; the nodes above (those of one context byte, and the root) join subtrees from 255 numbers for each.  The
log-probabilities go back to the groups that asked, bucket by bucket, in the order of their grams.  No model passes through the driver,
and the number of passes over the documents is two, whatever the size of the model.
Grams of texts that are only scored take part with count 0, so that every gram met in scoring has its own exact entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import exchange as X
from strandline.llm import kernels as K
from strandline.llm.common import slices, written

DEPTH = 5
END = 255
#: Bytes of text of one group: large, so that its distinct grams are few beside its text.
GROUP_BYTES = 16 << 20
#: Context bytes that a subtree hangs from.
TOP = 2
#: Bits of the next context byte by which such a subtree's grams are spread while they are counted and answered.
SPREAD = 4
#: Leading bits of a word's fingerprint that name its bucket.
WORD_BITS = 10
#: Grams of one row of a model at most.
PIECE = 1 << 18
_U = np.uint64


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln gamma(x) for x > 0, by Stirling's series after a shift to x + 8."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    r = 1 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov block probability."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - 1.1447298858494002


def grams(buf: np.ndarray, offs: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """The (depth + 1)-gram at every byte and end mark, and each document's bounds.

    Packed as nearest context byte first, ..., farthest, then the byte itself, so a context of any length is a prefix.
    Before a text stand end marks.
    """
    n = len(offs) - 1
    bounds = offs + np.arange(n + 1)
    tape = np.full(len(buf) + n * (depth + 1), END, np.uint8)
    doc = np.repeat(np.arange(n), np.diff(offs))
    tape[np.arange(len(buf)) + (doc + 1) * depth + doc] = buf
    at = np.arange(bounds[-1]) + (np.repeat(np.arange(n), np.diff(bounds)) + 1) * depth
    key = tape[at].astype(_U)
    for d in range(1, depth + 1):
        key |= tape[at - d].astype(_U) << _U(8 * (depth + 1 - d))
    return key, bounds


def merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k)
    k, c = k[order], c[order]
    new = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.empty(0, np.int64)
    return k[new], np.add.reduceat(c, new) if len(k) else c


class Level:
    """Nodes of one depth: for each decision (bit) of each context, counts, Pe and Pw."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts  # (context, byte), sorted; times seen
        self.nodes, self.ones, self.zeros, self.pe = [], [], [], []
        for bit in range(8):
            group = keys >> _U(8 - bit)
            head = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            node = np.cumsum(np.concatenate(([0], (group[1:] != group[:-1]).astype(np.int64))))
            one = np.add.reduceat(counts * ((keys >> _U(7 - bit)) & _U(1)).astype(np.int64), head).astype(np.float64)
            zero = np.add.reduceat(counts, head) - one
            self.nodes.append(node)
            self.ones.append(one)
            self.zeros.append(zero)
            self.pe.append(log_kt(zero, one))
        self.below: list[np.ndarray] = []  # ln of the product of the children's Pw
        self.pw: list[np.ndarray] = self.pe

    def above(self, depth: int) -> tuple[Level, np.ndarray]:
        """The level one context byte shorter (this one: of this depth), and each row's place in it."""
        key = (self.keys >> _U(16)) << _U(8) | self.keys & _U(255)
        keys, place = np.unique(key, return_inverse=True)
        up = Level(keys, np.bincount(place, self.counts, len(keys)).astype(np.int64))
        for bit in range(8):
            parent = np.empty(len(self.pe[bit]), np.int64)
            parent[self.nodes[bit]] = up.nodes[bit][place]
            up.below.append(np.bincount(parent, self.pw[bit], len(up.pe[bit])))
        up.pw = [np.logaddexp(pe, below) - np.log(2.0) for pe, below in zip(up.pe, up.below)]
        return up, place


class Subtree:
    """All levels from depth down to ``top`` under one run of ``top`` nearest context bytes."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int, top: int = TOP):
        self.levels, self.places = [Level(keys, counts)], []
        for d in range(depth, top, -1):
            up, place = self.levels[-1].above(d)
            self.levels.append(up)
            self.places.append(place)

    def summary(self) -> np.ndarray:
        """For the 255 decisions of a byte (1, then its leading bits): zeros, ones and ln Pw of the top level."""
        out, top = np.zeros((3, 256)), self.levels[-1]
        for bit in range(8):
            at = (1 << bit) + ((top.keys & _U(255)) >> _U(8 - bit)).astype(np.int64)
            for row, x in enumerate((top.zeros, top.ones, top.pw)):
                out[row, at] = x[bit][top.nodes[bit]]
        return out

    def scores(self, uppers: list[np.ndarray]) -> np.ndarray:
        """log10 of every gram's probability; uppers: for each level above, up to the root, zeros, ones and the sum of ln Pw of all its children."""
        keys = self.levels[0].keys
        total, byte = np.zeros(len(keys)), (keys & _U(255)).astype(np.int64)
        kt = lambda zeros, ones, bit: np.where(bit, ones + 0.5, zeros + 0.5) / (zeros + ones + 1)
        weights = [1 / (1 + np.exp(np.clip(u[2] - log_kt(u[0], u[1]), -700, 700))) for u in uppers]
        for bit in range(8):
            digit = (byte >> (7 - bit)) & 1
            place, p = np.arange(len(keys)), None
            for level, up in zip(self.levels, [None, *self.places]):
                if up is not None:
                    place = up[place]
                node = level.nodes[bit][place]
                here = kt(level.zeros[bit][node], level.ones[bit][node], digit)
                if p is None:
                    p = here
                else:
                    w = 1 / (1 + np.exp(np.clip(level.below[bit] - level.pe[bit], -700, 700)))[node]
                    p = w * here + (1 - w) * p
            node = (1 << bit) + (byte >> (8 - bit))
            for u, w in zip(uppers, weights):
                p = w[node] * kt(u[0][node], u[1][node], digit) + (1 - w[node]) * p
            total += np.log10(p)
        return total


def joined(summaries: list[np.ndarray]) -> np.ndarray:
    """The node above some subtrees, from their summaries: zeros, ones, and the sum of the children's ln Pw."""
    return np.sum(summaries, axis=0) if summaries else np.zeros((3, 256))


def own_summary(node: np.ndarray) -> np.ndarray:
    """The summary of a node from joined()."""
    return np.stack((node[0], node[1], np.logaddexp(log_kt(node[0], node[1]), node[2]) - np.log(2.0)))


class Table:
    """An exact look-up of 64-bit keys with evenly spread values: an index of their leading bits, then a short walk."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.bits = max(4, int(len(keys)).bit_length())
        sizes = np.bincount((self.keys >> _U(64 - self.bits)).astype(np.int64), minlength=1 << self.bits)
        self.starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, 0 where a key is missing, and which were found."""
        out, found = np.zeros(len(keys), self.values.dtype), np.zeros(len(keys), bool)
        slot = (keys >> _U(64 - self.bits)).astype(np.int64)
        at, end = self.starts[slot], self.starts[slot + 1]
        rows = np.flatnonzero(at < end)
        at = at[rows]
        while len(rows):
            hit = self.keys[at] == keys[rows]
            out[rows[hit]] = self.values[at[hit]]
            found[rows[hit]] = True
            at = at + 1
            go = ~hit & (at < end[rows])
            rows, at = rows[go], at[go]
        return out, found


ASKED = "pid int, kind string, bucket int, keys binary, counts binary"
COUNTS = "kind string, bucket int, keys binary, counts binary"
MODEL = "kind string, bucket int, keys binary, vals binary"
ANSWERS = "pid int, kind string, bucket int, vals binary"


def _shift(kind: str, depth: int) -> int:
    """How far a key (64 bits of a word, or a packed gram) is shifted for its bucket."""
    return 64 - WORD_BITS if kind == "word" else 8 * (depth + 1 - TOP) - SPREAD


def _cut(kind: str, keys: np.ndarray, depth: int) -> tuple[np.ndarray, list[int]]:
    """The bucket of each run of sorted keys, and the runs' bounds."""
    bucket = (keys >> _U(_shift(kind, depth))).astype(np.int64)
    heads = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(keys) else np.empty(0, np.int64)
    return bucket[heads], [*heads.tolist(), len(keys)]


def _packed(kind: str, keys: np.ndarray, depth: int) -> np.ndarray:
    """Keys as they are sent: grams without what their subtree tells, where the rest fits 32 bits."""
    return keys if kind == "word" or 8 * (depth + 1 - TOP) > 32 else keys.astype(np.uint32)


def _key_type(kind: str, depth: int):
    return np.uint64 if kind == "word" or 8 * (depth + 1 - TOP) > 32 else np.uint32


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    types = {"int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(zip(*rows) if rows else [[] for _ in fields], fields)], names=[n for n, _ in fields])


def _word_keys(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = K.LOWER[buf]
    start, end, bounds = K.words(low, offs)
    return K.word_hashes(low, start, end), bounds


def _distinct(table: pa.Table, depth: int, counted: bool) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The distinct grams and words of a group, sorted; if counted, with their counts in training texts."""
    held: dict[str, tuple[list, list]] = {"gram": ([], []), "word": ([], [])}
    for batch in slices(X.in_order(table), "text"):
        buf, offs = K.buffer(batch.column("text"))
        train = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        for kind, (keys, bounds) in (("gram", grams(buf, offs, depth)), ("word", _word_keys(buf, offs))):
            if not counted:
                held[kind][0].append(np.unique(keys))
                held[kind][1].append(np.zeros(len(held[kind][0][-1]), np.int64))
                continue
            mine = np.repeat(train, np.diff(bounds))
            for part, times in ((mine, 1), (~mine, 0)):
                found, n = np.unique(keys[part], return_counts=True)
                held[kind][0].append(found)
                held[kind][1].append(n * times)
    return {kind: merge(ks, cs) for kind, (ks, cs) in held.items()}


def _ask(depth: int):
    def run(table: pa.Table) -> pa.Table:
        pid, rows = table.column("pid")[0].as_py(), []
        for kind, (keys, counts) in _distinct(table, depth, True).items():
            buckets, cuts = _cut(kind, keys, depth)
            sent, n = _packed(kind, keys, depth), counts.astype(np.uint32)
            rows += [(pid, kind, b, sent[x:y].tobytes(), n[x:y].tobytes()) for b, x, y in zip(buckets.tolist(), cuts, cuts[1:])]
        return pa.Table.from_batches([_batch(ASKED, rows)])

    return run


def _merged(depth: int):
    """One run of merged counts for each (kind, bucket); the rows come in that order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ks, cs, held = None, [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            if at is not None:
                keys, counts = merge(ks, cs)
                yield _batch(COUNTS, [(*at, keys.tobytes(), counts.tobytes())])

        for batch in batches:
            for kind, bucket, keys, counts in zip(*(batch.column(k).to_pylist() for k in ("kind", "bucket", "keys", "counts"))):
                if (kind, bucket) != at:
                    yield from out()
                    at, ks, cs, held = (kind, bucket), [], [], 0
                ks.append(np.frombuffer(keys, _key_type(kind, depth)))
                cs.append(np.frombuffer(counts, np.uint32).astype(np.int64))
                held += len(ks[-1])
                if held > 2 * PIECE and len(ks) > 8 and held > 4 * len(ks[0]):
                    ks, cs = ([x] for x in merge(ks, cs))
                    held = len(ks[0])
        yield from out()

    return run


def _subtrees(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(nearest bytes, whole keys, counts) of gram rows that come in the order of their buckets."""
    at, ks, cs = None, [], []
    low = 8 * (depth + 1 - TOP)
    for batch in batches:
        for bucket, keys, counts in zip(*(batch.column(k).to_pylist() for k in ("bucket", "keys", "counts"))):
            top = bucket >> SPREAD
            if top != at:
                if at is not None:
                    yield at, np.concatenate(ks), np.concatenate(cs)
                at, ks, cs = top, [], []
            part = np.frombuffer(keys, _key_type("gram", depth)).astype(_U)
            ks.append(part | _U(top << low) if low <= 32 else part)
            cs.append(np.frombuffer(counts, np.int64))
    if at is not None:
        yield at, np.concatenate(ks), np.concatenate(cs)


def fit(docs: DataFrame, depth: int = DEPTH) -> tuple[DataFrame, DataFrame, dict]:
    """From docs (doc_id, text, h, pid, held_out): what the groups ask (ASKED), the model (MODEL), and the totals.

    vals of a gram are log10 probabilities (float), those of a word counts in training texts (long).
    """
    asked = written(docs.groupBy("pid").applyInArrow(_ask(depth), ASKED), "asked")  # packed: some thousand rows a group
    order = ["kind", "bucket"]
    counts = written(asked.select(*order, "keys", "counts").repartition(*order).sortWithinPartitions(*order).mapInArrow(_merged(depth), COUNTS), "counts")
    grams_ = counts.where("kind = 'gram'").withColumn("top", F.shiftright("bucket", SPREAD)).repartition("top").sortWithinPartitions("bucket")

    def summaries(batches):
        for top, keys, n in _subtrees(batches, depth):
            yield pa.RecordBatch.from_arrays([pa.array([top >> 8], pa.int32()), pa.array([Subtree(keys, n, depth).summary().tobytes()], pa.binary())], names=["nearest", "summary"])

    def join(key: tuple, table: pa.Table) -> pa.Table:
        node = joined([np.frombuffer(x.as_buffer()).reshape(3, 256) for x in table.column("summary")])
        return pa.table({"nearest": pa.array([key[0].as_py()], pa.int32()), "node": pa.array([node.tobytes()], pa.binary())})

    nodes = grams_.mapInArrow(summaries, "nearest int, summary binary").groupBy("nearest").applyInArrow(join, "nearest int, node binary")
    near = {r["nearest"]: np.frombuffer(bytes(r["node"])).reshape(3, 256) for r in nodes.collect()}  # 256 rows of 6 kB at most
    root = joined([own_summary(x) for x in near.values()])

    def score(batches):
        for top, keys, n in _subtrees(batches, depth):
            values = Subtree(keys, n, depth).scores([near[top >> 8], root]).astype(np.float32)
            buckets, cuts = _cut("gram", keys, depth)
            sent = _packed("gram", keys, depth)
            for b, x, y in zip(buckets.tolist(), cuts, cuts[1:]):
                for k in range(x, y, PIECE):
                    to = min(y, k + PIECE)
                    yield _batch(MODEL, [("gram", b, sent[k:to].tobytes(), values[k:to].tobytes())])

    words = counts.where("kind = 'word'")

    def total(batches):
        for b in batches:
            n = [np.frombuffer(x, np.int64) for x in b.column("counts").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([int(x.sum()) for x in n], pa.int64()), pa.array([int((x > 0).sum()) for x in n], pa.int64())], names=["n", "v"])

    n_words, n_known = words.select("counts").mapInArrow(total, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    n_docs = docs.where(~F.col("held_out")).count()
    totals = {"docs": n_docs, "tokens": n_docs + (n_words or 0), "vocabulary": (n_known or 0) + (n_docs > 0), "depth": depth}
    model = grams_.mapInArrow(score, MODEL).unionByName(words.withColumnRenamed("counts", "vals"))
    return asked, model, totals


def _answer(depth: int):
    """What the groups asked, from the model's rows of the same bucket, which come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, values, parts = None, None, None, []
        for batch in batches:
            out = []
            for pid, kind, bucket, k, v in zip(*(batch.column(c).to_pylist() for c in ("pid", "kind", "bucket", "keys", "vals"))):
                if (kind, bucket) != at:
                    at, parts, keys = (kind, bucket), [], None
                if pid is None:
                    parts.append((np.frombuffer(k, _key_type(kind, depth)), np.frombuffer(v, np.int64 if kind == "word" else np.float32)))
                    continue
                if keys is None:
                    keys, values = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
                    if len(parts) > 1:
                        order = np.argsort(keys)
                        keys, values = keys[order], values[order]
                found = values[np.searchsorted(keys, np.frombuffer(k, keys.dtype))]
                out.append((pid, kind, bucket, found.tobytes()))
            if out:
                yield _batch(ANSWERS, out)

    return run


def _finish(totals: dict):
    norm = np.log10(totals["tokens"] + totals["vocabulary"] + 1.0)
    depth, n_docs = totals["depth"], totals["docs"]
    names = [f.split()[0] for f in SCORES.split(", ")]
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        tables = {}
        for kind, (keys, _) in _distinct(table, depth, False).items():
            mine = answers.filter(pa.array([k == kind for k in answers.column("kind").to_pylist()], pa.bool_())).sort_by("bucket")
            values = np.concatenate([np.frombuffer(v.as_buffer(), np.int64 if kind == "word" else np.float32) for v in mine.column("vals")] + [np.empty(0, np.float32 if kind == "gram" else np.int64)])
            tables[kind] = Table(K.mix(keys) if kind == "gram" else keys, values)
        out = []
        for batch in slices(X.in_order(table), "text"):
            buf, offs = K.buffer(batch.column("text"))
            key, bounds = grams(buf, offs, depth)
            part = np.concatenate(([0], np.cumsum(tables["gram"].get(K.mix(key))[0].astype(np.float64))))
            words, wb = _word_keys(buf, offs)
            count = tables["word"].get(words)[0]
            base = np.concatenate(([0], np.cumsum(np.log10(count.astype(np.float64) + 1.0))))
            n_tokens = np.diff(wb) + 1
            columns = [
                batch.column("doc_id"), batch.column("held_out"), pa.array(n_tokens), pa.array(K.per_document(count > 0, wb) + (n_docs > 0)),
                pa.array(base[wb[1:]] - base[wb[:-1]] + np.log10(n_docs + 1.0) - norm * n_tokens), pa.array(part[bounds[1:]] - part[bounds[:-1]]), pa.array(np.diff(bounds)),
            ]
            out.append(pa.RecordBatch.from_arrays(columns, names=names))
        return pa.Table.from_batches(out)

    return run


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_symbols long"


def score_documents(docs: DataFrame, depth: int = DEPTH, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Every row of docs (doc_id, text, held_out), scored by a model of the rows that aren't held out.

    Returns doc_id, held_out, n_tokens (words and one end), n_known (of them met in training), train_tokens, base_score
    (add-one word model), score (log10 probability of the bytes and the end mark under context-tree weighting) and bits_per_byte
    (-score in bits over bytes plus end mark).  A null text is empty: only its end counts.  Without training rows every
    decision has probability 1/2.  An empty table gives no rows; other columns are ignored.  Repeated rows and null ids are
    scored each, equal texts alike.  A text must fit a task's memory some 60 times over.  depth is 2 at least.  group_bytes decides how documents are dealt, nothing else.
    """
    if depth < TOP:
        raise ValueError(f"depth must be at least {TOP}")
    rows = X.grouped(docs.select("doc_id", "text", "held_out"), group_bytes, ("held_out",))
    asked, model, totals = fit(rows, depth)
    order = ["kind", "bucket"]
    both = model.select(F.lit(None).cast("int").alias("pid"), *order, "keys", "vals").unionByName(asked.select("pid", *order, "keys", F.lit(None).cast("binary").alias("vals")))
    answers = both.repartition(*order).sortWithinPartitions(*order, F.col("pid").asc_nulls_first()).mapInArrow(_answer(depth), ANSWERS)
    out = rows.groupBy("pid").cogroup(answers.groupBy("pid")).applyInArrow(_finish(totals), SCORES)
    bits = (-F.col("score") * np.log2(10.0) / F.col("n_symbols")).alias("bits_per_byte")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(totals["tokens"]).cast("long").alias("train_tokens"), "base_score", "score", bits)


def held_out_split(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with held_out: crc32 of the id as text, modulo 7, is 2 (a null id trains)."""
    return docs.select("doc_id", "text", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False)).alias("held_out"))
