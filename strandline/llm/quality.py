"""Quality rules judged by an isolation forest.

Each document gives rule statistics (lengths, shares of symbols, repeats and so on).  Trees that split at random separate
unusual documents after few steps; the mean path length over all trees gives an anomaly score.  The forest is grown from a
bounded sample of labelled rows, good and bad, and the threshold is calibrated on all labelled rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import kernels as K
from strandline.llm.common import map_texts, written

#: Fixed rule parameters.
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Trees, and labelled rows for each; trees * rows bounds the sample that the forest is grown from.
TREES = 100
TREE_ROWS = 64
#: Most of the labelled good rows that the threshold may reject.
MAX_GOOD_REJECTED = 0.005
SEED = 11

_CONTINUES = np.zeros(256, bool)
_CONTINUES[128:192] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_distinct", "n_upper", "n_punct", "n_lines", "n_long_words"]
#: What the forest sees.
STATS = ["word_length", "symbols", "dup_lines", "distinct", "upper", "punct", "long_words"]


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """Counts of every text of a column."""
    buf, offs = K.buffer(column)
    start, end, bounds = K.words(buf, offs)
    n_words = np.diff(bounds)
    total = lambda flags: K.per_document(flags, offs)
    inside = K.IS_WORD[buf]
    sums = K.prefix(K.BYTE[buf])
    hashes = K.span(sums, start, end)
    # windows found twice or more in their document
    at, keys = K.windows(hashes, bounds, WINDOW)
    doc = np.searchsorted(bounds, at, side="right") - 1
    keys = K.mix(keys + doc.astype(np.uint64))
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    repeat = K.covered(at[again], WINDOW, len(start))
    # lines with a word
    breaks = np.flatnonzero(buf == 10)
    begin = np.unique(np.concatenate((offs[:-1], breaks + 1)))
    begin = begin[begin < len(buf)]
    stop = np.empty_like(begin)
    stop[:-1] = begin[1:]
    if len(stop):
        stop[-1] = len(buf)
    line_doc = np.searchsorted(offs, begin, side="right") - 1
    has_word = np.searchsorted(start, stop) > np.searchsorted(start, begin)
    stop = stop - ((stop > begin) & (buf[np.maximum(stop - 1, 0)] == 10))
    begin, stop, line_doc = begin[has_word], stop[has_word], line_doc[has_word]
    lines = K.mix(K.span(sums, begin, stop) + line_doc.astype(np.uint64))
    dup = K.first_seen(lines) != np.arange(len(lines))
    word_doc = K.owners(bounds)
    distinct = np.unique(K.mix(hashes + word_doc.astype(np.uint64)), return_index=True)[1]
    n = len(offs) - 1
    by_doc = lambda docs: np.bincount(docs, minlength=n).astype(np.int64)
    return {
        "n_words": n_words, "word_chars": total(inside & ~_CONTINUES[buf]), "n_symbols": total(_SYMBOL[buf]), "n_dup_lines": by_doc(line_doc[dup]),
        "n_repeat_words": K.per_document(repeat, bounds), "n_distinct": by_doc(word_doc[distinct]), "n_upper": total(_UPPER[buf]),
        "n_punct": total(_PUNCT[buf]), "n_lines": by_doc(line_doc), "n_long_words": K.per_document(end - start > 14, bounds),
    }


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every row of docs (doc_id, text)."""
    names = COUNTS + EXTRA

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = statistics(batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(out[k], pa.int64()) for k in names)], names=["doc_id", *names])

    return map_texts(docs.select("doc_id", "text"), step, ", ".join(["doc_id long", *(f"{k} long" for k in names)]))


def ratios(counts: dict[str, np.ndarray]) -> np.ndarray:
    """The forest's features, a row a document."""
    words = np.maximum(counts["n_words"], 1)
    chars = np.maximum(counts["word_chars"], 1)
    lines = np.maximum(counts["n_lines"], 1)
    x = {
        "word_length": counts["word_chars"] / words, "symbols": counts["n_symbols"] / words, "dup_lines": counts["n_dup_lines"] / lines,
        "distinct": np.log(np.maximum(counts["n_distinct"], 1)) / np.log(np.maximum(words, 2)), "upper": counts["n_upper"] / chars,
        "punct": counts["n_punct"] / words, "long_words": counts["n_long_words"] / words,
    }
    return np.column_stack([x[k] for k in STATS]).astype(np.float64)


class Forest:
    """Isolation trees as arrays: feature (-1: leaf), split, and the path length that a leaf stands for."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.depth = max(1, math.ceil(math.log2(max(2, min(rows, len(sample))))))
        size = (1 << (self.depth + 1)) - 1
        self.feature = np.full((trees, size), -1, np.int16)
        self.split = np.zeros((trees, size))
        self.path = np.zeros((trees, size))
        self.norm = self.average(min(rows, len(sample)))
        for t in range(trees):
            part = sample[rng.choice(len(sample), min(rows, len(sample)), replace=False)]
            stack = [(0, 0, part)]
            while stack:
                node, depth, x = stack.pop()
                low, high = x.min(0), x.max(0)
                able = np.flatnonzero(high > low)
                if depth == self.depth or len(x) < 2 or not len(able):
                    self.path[t, node] = depth + self.average(len(x))
                    continue
                f = int(rng.choice(able))
                cut = rng.uniform(low[f], high[f])
                self.feature[t, node], self.split[t, node] = f, cut
                left = x[:, f] <= cut
                stack += [(2 * node + 1, depth + 1, x[left]), (2 * node + 2, depth + 1, x[~left])] if left.any() and not left.all() else []
                if left.all() or not left.any():
                    self.feature[t, node] = -1
                    self.path[t, node] = depth + self.average(len(x))

    @staticmethod
    def average(n: int) -> float:
        """Mean path length of an unsuccessful search among n."""
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores in (0, 1): 2 ** -(mean path / average path)."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, split, path in zip(self.feature, self.split, self.path):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                inner = f >= 0
                node = np.where(inner, 2 * node + 1 + (x[rows, np.maximum(f, 0)] > split[node]), node)
            total += path[node]
        return 2.0 ** (-total / len(self.feature) / max(self.norm, 1e-9))


def _scored(counts: DataFrame, forest: Forest | None) -> DataFrame:
    names = COUNTS + EXTRA
    model = counts.sparkSession.sparkContext.broadcast(forest)  # TREES * 2**9 nodes at most

    def run(batches):
        for b in batches:
            x = {k: b.column(k).to_numpy() for k in names}
            score = np.zeros(b.num_rows) if model.value is None or not b.num_rows else model.value.score(ratios(x))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ["doc_id", *COUNTS]), pa.array(score)], names=["doc_id", *COUNTS, "anomaly"])

    return counts.mapInArrow(run, ", ".join(["doc_id long", *(f"{k} long" for k in COUNTS), "anomaly double"]))


def grow(labelled: DataFrame, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED) -> Forest | None:
    """A forest from the counts of labelled rows: those of the lowest seeded hashes, trees * rows of them at most."""
    names = COUNTS + EXTRA
    sample = labelled.orderBy(F.xxhash64("doc_id", F.lit(seed)), *names).limit(trees * rows).select(*names).toArrow()
    if sample.num_rows < 2:
        return None
    return Forest(ratios({k: sample.column(k).to_numpy() for k in names}), trees, rows, seed)


def calibrate(scored: DataFrame, max_good_rejected: float = MAX_GOOD_REJECTED) -> float:
    """The score above which documents are rejected, from all labelled rows (anomaly, quality).

    Of 1,000 steps, the one with the best share of bad rows rejected less good rows rejected, among those that reject
    max_good_rejected of the good rows at most; a tie goes to the highest.
    """
    step = F.floor(F.col("anomaly") * 1000).cast("int")
    counts = {(r["step"], r["quality"]): r["n"] for r in scored.where("quality IN (0, 1)").groupBy(step.alias("step"), "quality").agg(F.count("*").alias("n")).collect()}
    bad, good = (np.array([counts.get((k, q), 0) for k in range(1001)], float) for q in (0, 1))
    if not bad.sum() or not good.sum():
        return 1.0
    above_bad, above_good = (1 - np.cumsum(x) / x.sum() for x in (bad, good))
    gain = np.where(above_good <= max_good_rejected, above_bad - above_good, -1.0)
    return float((1000 - int(np.argmax(gain[::-1])) + 1) / 1000)


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of docs (doc_id, text), judged with labels (doc_id, quality): doc_id, the counts, anomaly, base_failed, kept.

    A null or empty text has no words and fails the base rule.  Repeated rows are judged each; where rows share a doc_id, all
    of them take part as labelled.  Labels without a document, or null, are ignored; without both kinds of label only the
    base rule judges.  An empty table gives no rows; other columns are ignored.  A text of any length is counted whole, and must fit a task's memory some 60
    times over; equal statistics have equal verdicts.
    """
    counts = written(document_statistics(docs), "counts")
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    forest = grow(counts.where(~failed).join(marks, "doc_id"))
    scored = _scored(counts, forest)
    threshold = calibrate(scored.where(~failed).join(marks, "doc_id")) if forest else 1.0
    return scored.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < threshold))
