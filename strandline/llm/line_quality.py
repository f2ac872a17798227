"""Quality of documents from their lines: a linear-chain conditional random field labels every line good or bad.

A line has statistics of its own and those of the lines before and after it.  The chain couples neighbours by weights between their labels.
Forward and backward messages are products of 2 x 2 matrices, taken for all lines of a batch at once by doubling spans; from them follow the marginals.
A document's score is the mean of its lines' marginals, weighted by their lengths, on a logistic scale fitted with the rest.

Only documents are labelled, so lines are labelled in rounds: all lines of a good document are good; those of a bad one are bad where the model of the
round before says so, and at least the worst of them is.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import kernels as K
from strandline.llm.common import map_texts

#: Most labelled rows that the model is fitted on (those of the lowest seeded hashes), and most lines of one of them; longer ones are not fitted on.
FIT_ROWS = 4000
FIT_LINES = 200
#: Words of a window whose repetition within the document counts.
WINDOW = 8
ROUNDS = 3
PENALTY = 1.0
SEED = 12

#: Statistics of a line.
STATS = ["log_words", "word_length", "symbols", "upper", "punctuation", "digits", "exclamations", "bars", "ends", "stutter", "distinct", "repeated", "known", "long_words"]


def _set(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


_SYMBOL, _EXCLAIM, _BAR, _END = _set("#*$%&<>"), _set("!"), _set("|"), _set(".!?;:")
_UPPER, _LETTER, _DIGIT = (_set("".join(c for c in map(chr, range(33, 127)) if f(c))) for f in (str.isupper, str.isalpha, str.isdigit))
_PUNCTUATION = _set("".join(c for c in map(chr, range(33, 127)) if not c.isalnum()))


def line_statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistics of every line with a word (rows), the bounds of documents among them, and the lengths of lines in bytes of words."""
    buf, offs = K.buffer(column)
    start, end, bounds = K.words(buf, offs)
    begin = np.unique(np.concatenate((offs[:-1], np.flatnonzero(buf == 10) + 1)))
    begin = begin[begin < len(buf)]
    stop = np.append(begin[1:], len(buf))[: len(begin)]
    first, last = np.searchsorted(start, begin), np.searchsorted(start, stop)
    kept = last > first
    begin, stop, first, last = begin[kept], stop[kept], first[kept], last[kept]
    doc = np.searchsorted(offs, begin, side="right") - 1
    lines = np.searchsorted(doc, np.arange(len(offs)))
    if not len(begin):
        return np.zeros((0, len(STATS))), lines, np.zeros(0)

    def share(flags: np.ndarray, a: np.ndarray, b: np.ndarray, of: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return (total[b] - total[a]) / np.maximum(of, 1)

    n_words = last - first
    size = np.concatenate(([0], np.cumsum(end - start)))
    length = (size[last] - size[first]).astype(np.float64)
    letters = share(_LETTER[buf], begin, stop, np.ones(len(begin)))
    sums = K.prefix(K.BYTE[buf])
    hashes = K.span(sums, start, end)
    own = K.owners(bounds)
    stutter = np.zeros(len(start), bool)
    stutter[1:] = (hashes[1:] == hashes[:-1]) & (own[1:] == own[:-1])
    of_line = np.repeat(np.arange(len(first)), n_words)  # every word lies in a line that has one
    new = np.zeros(len(start), bool)
    new[np.unique(K.mix(hashes + of_line.astype(np.uint64)), return_index=True)[1]] = True
    at, keys = K.windows(hashes, bounds, WINDOW)
    keys = K.mix(keys + own[at].astype(np.uint64))
    seen = K.first_seen(keys)
    again = np.zeros(len(keys), bool)
    twice = seen != np.arange(len(keys))
    again[twice] = True
    again[seen[twice]] = True
    repeated = K.covered(at[again], WINDOW, len(start))
    text = K.mix(K.span(sums, start[first], end[last - 1]) + doc.astype(np.uint64))
    x = [
        np.log1p(n_words), np.log1p(length / n_words), share(_SYMBOL[buf], begin, stop, length), share(_UPPER[buf], begin, stop, letters), share(_PUNCTUATION[buf], begin, stop, n_words),
        share(_DIGIT[buf], begin, stop, length), share(_EXCLAIM[buf], begin, stop, n_words), share(_BAR[buf], begin, stop, n_words), _END[buf[end[last - 1] - 1]],
        share(stutter, first, last, n_words), share(new, first, last, n_words), share(repeated, first, last, n_words), K.first_seen(text) != np.arange(len(text)), share(end - start > 14, first, last, n_words),
    ]
    return np.column_stack(x).astype(np.float64), lines, length


def neighbours(x: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Statistics of each line, of the one before and the one after (0 beyond the document), whether it is the first or last, and 1."""
    n, d = x.shape
    out = np.zeros((n, 3 * d + 3))
    out[:, :d], out[:, -1] = x, 1.0
    heads, tails = np.zeros(n, bool), np.zeros(n, bool)
    full = np.diff(lines) > 0
    heads[lines[:-1][full]] = True
    tails[lines[1:][full] - 1] = True
    inner = np.flatnonzero(~heads)
    out[inner, d : 2 * d] = x[inner - 1]
    inner = np.flatnonzero(~tails)
    out[inner, 2 * d : 3 * d] = x[inner + 1]
    out[:, -3], out[:, -2] = heads, tails
    return out


def _products(m: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Products of the matrices from the beginning of each document (place 0) to each line, scaled, and the logarithms of their scales."""
    out, scale = m.copy(), np.zeros(len(m))
    step, longest = 1, int(place.max(initial=0))
    while step <= longest:
        at = np.flatnonzero(place >= step)
        product = out[at - step] @ out[at]
        most = product.max(axis=(1, 2))
        scale[at] += scale[at - step] + np.log(most)
        out[at] = product / most[:, None, None]
        step *= 2
    return out, scale


class Chain:
    """Weights of a line's features for the label good, and of pairs of neighbouring labels."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray):
        self.weights, self.pairs = weights, pairs

    def messages(self, x: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each line the messages from before (itself included) and from behind, its weights of both labels; for each document log Z."""
        n = len(x)
        place = np.arange(n) - np.repeat(lines[:-1], np.diff(lines))
        score = np.clip(x @ self.weights, -40, 40)
        emit = np.stack([np.exp(-score / 2), np.exp(score / 2)], axis=1)
        pairs = np.exp(self.pairs)
        step = pairs[None] * emit[:, None, :]
        step[place == 0] = emit[place == 0][:, None, :] * np.array([[1.0], [0.0]])  # the first line has no pair
        top = step.max(axis=(1, 2))
        before, scale = _products(step / top[:, None, None], place)
        ahead = before[:, 0, :]
        logs = np.concatenate(([0.0], np.cumsum(np.log(top))))
        has = np.diff(lines) > 0
        tail = lines[1:][has] - 1
        log_z = np.zeros(len(lines) - 1)
        log_z[has] = np.log(ahead[tail].sum(1)) + scale[tail] + logs[lines[1:][has]] - logs[lines[:-1][has]]
        back = np.ones((n, 2, 2))
        inner = np.flatnonzero(place[1:] > 0)  # lines that another follows
        back[inner] = pairs[None] * emit[inner + 1][:, None, :]
        back /= back.max(axis=(1, 2))[:, None, None]
        from_end = np.repeat(lines[1:], np.diff(lines)) - 1 - np.arange(n)
        behind = _products(back[::-1].transpose(0, 2, 1), from_end[::-1])[0][::-1].sum(1)
        return ahead / ahead.sum(1, keepdims=True), behind / behind.sum(1, keepdims=True), emit, log_z

    def marginals(self, x: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Probability of each line to be good, given all lines of its document."""
        if not len(x):
            return np.zeros(0)
        ahead, behind, _, _ = self.messages(x, lines)
        both = ahead * behind
        return both[:, 1] / both.sum(1)

    def loss(self, x: np.ndarray, lines: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray]:
        """Penalised negative log-likelihood of the labels, and its gradient by weights and pairs."""
        ahead, behind, emit, log_z = self.messages(x, lines)
        both = ahead * behind
        good = both[:, 1] / both.sum(1)
        score = np.clip(x @ self.weights, -40, 40)
        inner = np.flatnonzero(np.arange(len(x)) - np.repeat(lines[:-1], np.diff(lines)) > 0)
        joint = ahead[inner - 1][:, :, None] * np.exp(self.pairs)[None] * (emit[inner] * behind[inner])[:, None, :]
        joint /= joint.sum(axis=(1, 2))[:, None, None]
        seen = np.zeros((2, 2))
        np.add.at(seen, (labels[inner - 1], labels[inner]), 1)
        value = log_z.sum() - (score * (labels - 0.5)).sum() - (seen * self.pairs).sum() + PENALTY / 2 * ((self.weights**2).sum() + (self.pairs**2).sum())
        return value, np.concatenate((x.T @ (good - labels) + PENALTY * self.weights, (joint.sum(0) - seen + PENALTY * self.pairs).ravel()))


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int = 80, kept: int = 8) -> np.ndarray:
    """A smooth convex function's minimum by limited-memory BFGS with halved steps."""
    value, slope = f(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, used = slope.copy(), []
        for s, y in reversed(pairs):
            a = (s @ way) / (y @ s)
            used.append(a)
            way -= a * y
        if pairs:
            s, y = pairs[-1]
            way *= (s @ y) / (y @ y)
        else:
            way /= max(1.0, np.abs(way).sum())
        for (s, y), a in zip(pairs, reversed(used)):
            way += (a - (y @ way) / (y @ s)) * s
        length, fall = 1.0, slope @ way
        while length > 1e-6:
            there = x - length * way
            v, g = f(there)
            if v <= value - 1e-4 * length * fall:
                break
            length /= 2
        else:
            return x
        if (there - x) @ (g - slope) > 1e-12:
            pairs = [*pairs, (there - x, g - slope)][-kept:]
        done = value - v < 1e-6 * max(1.0, abs(value))
        x, value, slope = there, v, g
        if done:
            break
    return x


class Model:
    """The chain, the scale of its statistics, and the logistic scale of documents."""

    def __init__(self, x: np.ndarray, lines: np.ndarray, length: np.ndarray, quality: np.ndarray):
        self.mean, self.spread = x.mean(0), np.maximum(x.std(0), 1e-6)
        self.prior = float((quality.sum() + 1) / (len(quality) + 2))
        features = neighbours(self.scaled(x), lines)
        d, of = features.shape[1], np.repeat(np.arange(len(quality)), np.diff(lines))
        labels = quality[of]
        own = np.r_[0 : len(STATS), d - 1]  # first each line by itself, so that good lines beside bad ones show
        point = np.zeros(d + 4)
        point[own] = minimise(lambda w: self._logistic(w, features[:, own], labels), np.zeros(len(own)))
        good = 1 / (1 + np.exp(-np.clip(features @ point[:d], -500, 500)))
        for _ in range(ROUNDS):
            worst = np.full(len(quality), np.inf)
            np.minimum.at(worst, of, good)
            labels = np.where((quality[of] == 1) | ((good > 0.5) & (good > worst[of])), 1, 0)
            point = minimise(lambda w: Chain(w[:d], w[d:].reshape(2, 2)).loss(features, lines, labels), point)  # noqa: B023
            good = Chain(point[:d], point[d:].reshape(2, 2)).marginals(features, lines)
        self.chain = Chain(point[:d], point[d:].reshape(2, 2))
        share, some = self._shares(good, lines, length)
        inputs = np.column_stack((share - 0.5, np.ones(len(share))))[some]
        self.slope, self.shift = minimise(lambda w: self._logistic(w, inputs, quality[some]), np.zeros(2)).tolist()

    @staticmethod
    def _logistic(w: np.ndarray, x: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray]:
        score = x @ w
        p = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
        return float((np.logaddexp(0, score) - labels * score).sum() + PENALTY / 2 * (w @ w)), x.T @ (p - labels) + PENALTY * w

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8)

    @staticmethod
    def _shares(good: np.ndarray, lines: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        some = np.diff(lines) > 0
        share = np.zeros(len(some))
        at = lines[:-1][some]  # sums of each document by itself, so that equal texts score alike
        if len(at):
            share[some] = np.round(np.add.reduceat(length * good, at) / np.add.reduceat(length, at), 9)
        return share, some

    def lines(self, x: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Probability of each line to be good."""
        return self.chain.marginals(neighbours(self.scaled(x), lines), lines)

    def documents(self, x: np.ndarray, lines: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score of each document, and the share of its length in good lines (marginals)."""
        share, some = self._shares(self.lines(x, lines), lines, length)
        score = 1 / (1 + np.exp(-(self.slope * (share - 0.5) + self.shift)))
        return np.where(some, score, self.prior), np.where(some, share, np.nan)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, most_lines: int = FIT_LINES) -> Model | None:
    """A model from docs (doc_id, text) and labels (doc_id, quality): of the labels of lowest seeded hashes, ``rows`` at most, those that have a text of most_lines
    lines at most.  None where labels of one kind are missing."""
    marks = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = marks.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # FIT_ROWS rows at most

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, lines, length = line_statistics(batch.column("text"))
        n = np.diff(lines)
        rows = np.flatnonzero((n > 0) & (n <= most_lines))
        parts = [[x[lines[i] : lines[i + 1]].ravel() for i in rows], [length[lines[i] : lines[i + 1]] for i in rows]]
        kinds = [pa.list_(pa.float64())] * 2
        take = pa.array(rows)
        columns = [batch.column("doc_id").take(take), batch.column("quality").take(take), *(pa.array(p, k) for p, k in zip(parts, kinds))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality", "x", "length"])

    sample = map_texts(texts, step, "doc_id long, quality int, x array<double>, length array<double>").orderBy("doc_id", F.hash("length", "x")).limit(rows).toArrow()
    quality = sample.column("quality").to_numpy().astype(np.int64)
    if not quality.any() or quality.all():
        return None
    length = sample.column("length").combine_chunks()
    lines = length.offsets.to_numpy().astype(np.int64)
    x = sample.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(STATS))
    return Model(x, lines - lines[0], length.flatten().to_numpy(), quality)


def score_lines(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of docs (doc_id, text): doc_id, good (the probability of each line with a word to be good, in order)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some hundred numbers

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, lines, _ = line_statistics(batch.column("text"))
        good = pa.ListArray.from_arrays(pa.array(lines, pa.int32()), pa.array(shared.value.lines(x, lines)))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), good], names=["doc_id", "good"])

    return map_texts(docs.select("doc_id", "text"), step, "doc_id long, good array<double>")


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """Every row of docs (doc_id, text), scored by a model learned from labels (doc_id, quality) of rows that aren't held out.

    Returns doc_id, held_out (the CRC-32 of the decimal doc_id leaves the remainder held_out by folds; a null id is not), score (0 to 1, higher: good is
    likelier), predicted (1 from 0.5), good_share (of its length, by the lines' marginals; null without words).  Labels that are null, or without a document,
    are ignored, the lesser of several counts.  Without labels of both kinds all scores are 0.5.  Null, empty and blank texts have no line, and score as
    the share of good labels; repeated rows score alike; a text of any length is scored whole, so it must fit a task's memory some 60 times
    over; an empty table gives no rows; other columns are ignored.  Nothing of doc_id or labels enters a score but through the fit.
    """
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held_out, F.lit(False))
    model = fit(docs, labels.where(~out))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some hundred numbers

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        score, share = np.full(n, 0.5), np.full(n, np.nan)
        if shared.value is not None:
            score, share = shared.value.documents(*line_statistics(batch.column("text")))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array(share, from_pandas=True)], names=["doc_id", "score", "good_share"])

    scored = map_texts(docs.select("doc_id", "text"), step, "doc_id long, score double, good_share double")
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "good_share")
