"""Removal of repeated word spans, by anchors on a difference cover.

A window of ``size`` words is removed where its words also start earlier.  Fingerprints of short runs of words are taken only
where the place in the document, modulo the period, lies in a difference cover: for any two places some shift below the period brings
both onto the cover, so two equal windows share an aligned anchor of size - period + 1 words.  First round: which anchors
occur twice.  Only windows that hold such an anchor can be repeated; they are extended to their full length, and the second
round finds where each begins first.  Both rounds shuffle narrow rows by key, one for each distinct key of a group of documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm import exchange as X
from strandline.llm import kernels as K
from strandline.llm.common import slices

SIZE = 20
#: A perfect difference set, whose differences give each residue modulo 13 but 0 once.
PERIOD = 13
COVER = (0, 1, 3, 9)


class Group:
    """The words of a group's documents, and its anchors."""

    def __init__(self, table: pa.Table, size: int):
        self.batch = X.in_order(table)
        hashes, counts = [np.empty(0, np.uint64)], [np.zeros(0, np.int64)]
        for part in slices(self.batch, "text"):
            buf, offs = K.buffer(part.column("text"))
            start, end, bounds = K.words(buf, offs)
            hashes.append(K.word_hashes(buf, start, end))
            counts.append(np.diff(bounds))
        self.hashes, self.counts = np.concatenate(hashes), np.concatenate(counts)
        self.bounds = np.concatenate(([0], np.cumsum(self.counts)))
        self.size, self.sums = size, K.prefix(self.hashes)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places (word numbers), documents and fingerprints of the runs that begin on the cover."""
        length = self.size - PERIOD + 1
        at = K.runs(self.bounds[:-1], self.counts - length + 1)
        doc = np.searchsorted(self.bounds, at, side="right") - 1
        on = np.zeros(PERIOD, bool)
        on[list(COVER)] = True
        chosen = on[(at - self.bounds[doc]) % PERIOD]
        at, doc = at[chosen], doc[chosen]
        return at, doc, K.span(self.sums, at, at + length).view(np.int64)

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold a repeated anchor."""
        at, doc, keys = self.anchors()
        hit = X.found(keys, repeated)[0]
        at, doc = at[hit], doc[hit]
        low = np.maximum(at - PERIOD + 1, self.bounds[doc])
        high = np.minimum(at, self.bounds[doc + 1] - self.size)
        ok = low <= high
        n = len(self.hashes) + 1
        steps = np.bincount(low[ok], minlength=n + 1) - np.bincount(high[ok] + 1, minlength=n + 1)
        return np.flatnonzero(np.cumsum(steps) > 0)

    def windows(self, starts: np.ndarray) -> np.ndarray:
        return K.span(self.sums, starts, starts + self.size).view(np.int64)


def _keys(table: pa.Table) -> np.ndarray:
    return np.sort(table.column("key").to_numpy())


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Every row of docs (doc_id, text): doc_id, n_words, n_removed, kept_sha256, kept_text.

    Words are runs of characters other than space and \\t..\\r, unchanged.  A word goes if a window of ``size`` (14 at least)
    consecutive words that covers it also starts earlier: in a smaller doc_id (null: the largest), or before in the same document; of
    rows that share a doc_id a hash of the text decides, and equal rows count as one after the other.  Windows are judged on the input.
    kept_text joins what stays by spaces; kept_sha256 is its digest.  Null or blank texts have no words.  An empty table gives no
    rows; other columns are ignored.  A text must fit a task; windows are compared as fingerprints.
    """
    if size <= PERIOD:
        raise ValueError(f"size must be above {PERIOD}")
    rows = X.grouped(docs)

    def ask(table: pa.Table) -> pa.Table:
        keys, n = np.unique(Group(table, size).anchors()[2], return_counts=True)
        return pa.table({"pid": pa.array(np.full(len(keys), table.column("pid")[0].as_py(), np.int32)), "key": pa.array(keys), "several": pa.array(n > 1)})

    def extend(table: pa.Table, anchors: pa.Table) -> pa.Table:
        """Distinct candidate windows of the group: the document where each is first, and whether the group has it several times.  They go
        in the order of documents, so that what is the same from row to row takes little room."""
        names, types = ["pid", "doc_id", "several", "key"], [pa.int32(), pa.int64(), pa.bool_(), pa.int64()]
        if not table.num_rows or not anchors.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        g = Group(table, size)
        starts = g.candidates(_keys(anchors))
        keys, first, n = np.unique(g.windows(starts), return_index=True, return_counts=True)
        order = np.argsort(first)
        keys, first, n = keys[order], first[order], n[order]
        doc = pa.array(np.searchsorted(g.bounds, starts[first], side="right") - 1)
        pid = np.full(len(keys), table.column("pid")[0].as_py(), np.int32)
        return pa.table([pa.array(pid), g.batch.column("doc_id").take(doc), pa.array(n > 1), pa.array(keys)], names=names)

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        if not table.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        g = Group(table, size)
        gone = np.zeros(len(g.hashes), bool)
        if answers.num_rows:
            answers = answers.sort_by("key")
            wanted, every = answers.column("key").to_numpy(), answers.column("every").to_numpy(zero_copy_only=False).astype(bool)
            starts = K.runs(g.bounds[:-1], g.counts - size + 1)
            hit, which = X.found(g.windows(starts), wanted)
            starts, which = starts[hit], which[hit]
            first = np.zeros(len(starts), bool)
            first[np.unique(which, return_index=True)[1]] = True
            gone = K.covered(starts[every[which] | ~first], size, len(g.hashes))
        texts, at = [], 0
        for part in slices(g.batch, "text"):
            buf, offs = K.buffer(part.column("text"))
            start, end, bounds = K.words(buf, offs)
            keep = ~gone[at : at + len(start)]
            at += len(start)
            length = (end - start + 1)[keep]
            raw = np.append(buf, np.uint8(32))[K.runs(start[keep], length)]
            raw[np.cumsum(length) - 1] = 32
            cuts = np.concatenate(([0], np.cumsum(length)))[np.concatenate(([0], np.cumsum(keep)))[bounds]]
            raw = raw.tobytes()
            texts += [raw[a : max(a, b - 1)] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
        digests = [hashlib.sha256(t).hexdigest() for t in texts]
        lost = K.per_document(gone, g.bounds)
        columns = [g.batch.column("doc_id"), pa.array(g.counts, pa.int64()), pa.array(lost, pa.int64()), pa.array(digests), pa.array(texts, pa.binary()).cast(pa.string())]
        return pa.table(columns, names=names)

    by_key = Window.partitionBy("key")
    asked = rows.groupBy("pid").applyInArrow(ask, "pid int, key long, several boolean")
    anchors = asked.withColumn("m", F.count("*").over(by_key)).where("m > 1 OR several").select("pid", "key")
    extended = rows.groupBy("pid").cogroup(anchors.groupBy("pid")).applyInArrow(extend, "pid int, doc_id long, several boolean, key long")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "pid")  # rows that share a doc_id: by their groups, in a group by their texts' hashes
    later = extended.withColumn("every", place != F.min(place).over(by_key)).where("every OR several").select("pid", "key", "every")
    return rows.groupBy("pid").cogroup(later.groupBy("pid")).applyInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
