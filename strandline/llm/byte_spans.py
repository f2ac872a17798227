"""Removal of repeated byte strings, by sorting suffixes.

A byte goes if a string of ``size`` bytes that covers it also starts elsewhere.  The suffixes that can take part are found
first: every window of ``short`` bytes has one anchor, its least fingerprint of ANCHOR bytes (the leftmost of equals), so equal windows
have equal anchors at equal places.  Consecutive windows with the same anchor make a record: the suffix that begins at its first
window, as far as its last window's ``size`` bytes.  Only records whose anchor is met twice are sent, with their bytes.

Spark deals them into ranges by their leading bytes at the anchor, with splitters that it samples, and orders each range by them.
A task takes its range in runs of one anchor.  First the records of a run are ordered as strings by multikey quicksort, eight bytes
a step, which brings equal ones together; then, where different records are left, the suffixes at all their windows are ordered in the
same way, and neighbours that agree in ``size`` (``short``) bytes are repeats.  Bytes are compared, not fingerprints, so the result is
exact.  A run never lies across the boundary of ranges, as equal leading bytes and anchors go to one range; so windows that are equal always meet.
The records of an anchor met very often are cut into classes of nearby windows, dealt by the bytes that all windows of the
class share, which spreads a common line with different surroundings over the ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm import exchange as X
from strandline.llm import kernels as K
from strandline.llm.common import slices, written

SIZE = 400
#: Shorter strings whose repeats are only counted: about 50 words of six bytes.
SHORT = 304
ANCHOR = 48
#: Occurrences of an anchor beyond which its records are cut into classes of so many windows.
HOT = 4096
CLASS = 32
#: Bytes of records that one sorting step takes together (at least one run).
STEP_BYTES = 4 << 20
_PLACE = np.uint64((1 << 28) - 1)
_BASE = 0x9E3779B97F4A7C15
RECORDS = "pid int, rec int, lead long, anchor long, sub long, place int, n int, many boolean, content binary"
FLAGS = "pid int, rec int, short binary, long binary"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, from running minima of blocks in both directions."""
    n = len(values)
    if n < width:
        return np.empty(0, values.dtype)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


class Prints:
    """Quick fingerprints of spans, modulo 2**64: good for dealing, where a false match costs time only."""

    _power = _inverse = np.ones(0, np.uint64)

    def __init__(self, buf: np.ndarray):
        n = len(buf) + 1
        if len(Prints._power) < n:
            m = max(n, 1 << 16)
            for name, base in (("_power", _BASE), ("_inverse", pow(_BASE, -1, 1 << 64))):
                x = np.full(m, np.uint64(base))
                x[0] = 1
                setattr(Prints, name, np.multiply.accumulate(x))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(K.BYTE[buf] * Prints._power[: n - 1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return K.mix((self.sums[end] - self.sums[start]) * Prints._inverse[start])


def words_of(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as big-endian numbers; zeros beyond the end."""
    x = np.concatenate((buf, np.zeros(7, np.uint8))).astype(np.uint64)
    out = np.zeros(len(buf), np.uint64)
    for k in range(8):
        out <<= K.U(8)
        out |= x[k : k + len(buf)]
    return out


class Suffixes:
    """Suffixes in order, by multikey quicksort: each step orders the runs of suffixes that agree so far by their next 8 bytes
    and leaves out those that are alone."""

    def __init__(self, words: np.ndarray, at: np.ndarray, run: np.ndarray):
        """at: places of the suffixes; run: those of different runs are not compared."""
        self.words, self.at = words, at
        self.order = np.argsort(run, kind="stable")
        run = run[self.order]
        self.cut(np.concatenate(([True], run[1:] != run[:-1])) if len(run) else np.empty(0, bool))

    def cut(self, heads: np.ndarray) -> None:
        alone = heads & np.append(heads[1:], True)[: len(heads)]
        self.order, self.run = self.order[~alone], (np.cumsum(heads) - 1)[~alone]

    def step(self, depth: int, n_bytes: int = 8) -> None:
        """Refine by the bytes at depth."""
        key = self.words[self.at[self.order] + depth]
        if n_bytes < 8:
            key &= K.U((1 << 64) - (1 << 8 * (8 - n_bytes)))
        heads = np.ones(len(key), bool)
        heads[1:] = self.run[1:] != self.run[:-1]
        differ = np.zeros(len(key), bool)
        differ[1:] = (key[1:] != key[:-1]) & ~heads[1:]
        if not differ.any():
            return
        torn = np.zeros(int(self.run[-1]) + 1, bool)
        torn[self.run[differ]] = True
        some = np.flatnonzero(torn[self.run])
        inner = np.lexsort((key[some], self.run[some]))
        self.order[some], key[some] = self.order[some[inner]], key[some[inner]]
        heads[1:] |= key[1:] != key[:-1]
        self.cut(heads)

    def to(self, depth: int, limit: int) -> None:
        """Refine by the bytes from depth (a multiple of 8) to limit."""
        for d in range(depth, limit, 8):
            if not len(self.order):
                return
            self.step(d, min(8, limit - d))

    def only(self, keep: np.ndarray) -> None:
        """Leave those out that don't have keep."""
        mine = keep[self.order]
        self.order, run = self.order[mine], self.run[mine]
        self.cut(np.concatenate(([True], run[1:] != run[:-1])) if len(run) else np.empty(0, bool))


def repeated_windows(contents: list, anchor: np.ndarray, place: np.ndarray, n: np.ndarray, many: np.ndarray, size: int, short: int) -> tuple[np.ndarray, np.ndarray]:
    """For all windows of the records, in order: whether short, and whether size, bytes from it on are there again.

    A record has n windows, its anchor at place; many says that it stands for several equal ones.
    """
    length = np.array([len(c) for c in contents], np.int64)
    room = (length + 7) // 8 * 8
    start = np.concatenate(([0], np.cumsum(room)))
    buf = np.zeros(int(start[-1]) + 8, np.uint8)
    for at, content in zip(start.tolist(), contents):
        buf[at : at + len(content)] = content
    words = words_of(buf)
    # equal records, by their whole strings
    kind = np.unique(np.column_stack((anchor, place, n, length)), axis=0, return_inverse=True)[1].ravel()
    strings = Suffixes(words, start[:-1], kind)
    equal, depth = many.copy(), 0
    leader = np.arange(len(contents))  # one of the equal ones takes part from here on
    while len(strings.order):
        strings.step(depth)
        depth += 8
        done = (room <= depth)[strings.order]
        if done.any():
            which, run = strings.order[done], strings.run[done]
            equal[which] = True
            leader[which] = which[np.searchsorted(run, run)]
            strings.only(room > depth)
    # suffixes at the windows of different records of one anchor
    first = leader == np.arange(len(contents))
    names, which, count = np.unique(anchor[first], return_inverse=True, return_counts=True)
    mixed = np.zeros(len(contents), bool)
    mixed[np.flatnonzero(first)[count[which] > 1]] = True
    bounds = np.concatenate(([0], np.cumsum(n)))
    owner = np.repeat(np.arange(len(contents)), n)
    at = start[owner] + np.arange(bounds[-1]) - bounds[owner]
    left = length[owner] - (at - start[owner])
    shorts = equal[owner]
    longs = shorts & (left >= size)
    wanted = np.flatnonzero(mixed[owner])
    if len(wanted):
        suffixes = Suffixes(words, at[wanted], np.unique(anchor[owner[wanted]], return_inverse=True)[1].ravel())
        suffixes.to(0, short)
        shorts[wanted[suffixes.order]] = True
        suffixes.only(left[wanted] >= size)
        suffixes.to(short // 8 * 8, size)
        longs[wanted[suffixes.order]] = True
    return shorts, longs


class Slice:
    """Some documents' bytes and records: anchor, first and last window and the anchor's place (in the slice), document."""

    def __init__(self, part: pa.RecordBatch, short: int):
        self.buf, self.offs = K.buffer(part.column("text"))
        starts = K.runs(self.offs[:-1], np.diff(self.offs) - short + 1)
        if not len(starts):
            self.low = self.high = self.doc = self.place = np.empty(0, np.int64)
            self.anchor = self.low
            return
        self.prints = Prints(self.buf)
        at = np.arange(len(self.buf) - ANCHOR + 1)
        prints = self.prints(at, at + ANCHOR)
        least = sliding_least((prints & ~_PLACE) | at.astype(np.uint64), short - ANCHOR + 1)
        place = (least[starts] & _PLACE).astype(np.int64)
        doc = np.searchsorted(self.offs, starts, side="right") - 1
        new = np.ones(len(starts), bool)
        new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(new)
        self.low, self.high, self.doc = starts[head], starts[np.append(head[1:], len(starts)) - 1], doc[head]
        self.place = place[head]
        self.anchor = prints[self.place].view(np.int64)

    def take(self, anchors: np.ndarray, counts: np.ndarray, short: int) -> tuple:
        """The records of these anchors (sorted; how often each is met), those of frequent ones cut: rows and sub, the print of shared bytes."""
        hit, which = X.found(self.anchor, anchors)
        rows = np.flatnonzero(hit)
        hot = counts[which[rows]] > HOT if len(anchors) else np.zeros(len(rows), bool)
        low, high, place, doc, anchor = (x[rows] for x in (self.low, self.high, self.place, self.doc, self.anchor))
        first, last = (place - high) // CLASS, (place - low) // CLASS
        n = np.where(hot, last - first + 1, 1)
        of = np.repeat(np.arange(len(rows)), n)
        c = K.runs(first, n)
        cut = hot[of]
        low, high, place, doc, anchor = (x[of] for x in (low, high, place, doc, anchor))
        low = np.where(cut, np.maximum(low, place - c * CLASS - CLASS + 1), low)
        high = np.where(cut, np.minimum(high, place - c * CLASS), high)
        sub = np.zeros(len(of), np.int64)
        if cut.any():
            common = (place - c * CLASS)[cut]
            sub[cut] = self.prints(common, common + short - CLASS + 1).view(np.int64)
        return low, high, place, doc, anchor, sub


def _group_records(table: pa.Table, anchors: np.ndarray, counts: np.ndarray, size: int, short: int) -> Iterator[tuple]:
    """For each slice of a group, the slice and its records, each with the number of its first equal in the group, and those that are first."""
    known: dict[tuple, int] = {}
    for part in slices(X.in_order(table), "text"):
        s = Slice(part, short)
        low, high, place, doc, anchor, sub = s.take(anchors, counts, short) if len(s.low) else (np.empty(0, np.int64),) * 6
        raw, number, fresh = s.buf.tobytes(), np.empty(len(low), np.int64), []
        end = np.minimum(high + size, s.offs[doc + 1])
        for k, (a, b, p, x, y) in enumerate(zip(low.tolist(), end.tolist(), (place - low).tolist(), anchor.tolist(), sub.tolist())):
            key, new = (x, y, p, int(high[k] - low[k]) + 1, raw[a:b]), len(known)
            number[k] = at = known.setdefault(key, new)
            if at == new:
                fresh.append(key)
        yield part, s, low, high, number, fresh


def remove_repeats(docs: DataFrame, size: int = SIZE, short: int = SHORT) -> DataFrame:
    """Every row of docs (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_repeated, kept.

    A byte of the UTF-8 text goes if a string of ``size`` bytes that covers it starts at another place too, in the same document or
    any other; strings never cross documents and are judged on the input.  n_spans counts the maximal removed runs; n_repeated the
    bytes covered by repeated strings of ``short`` bytes (no more than size, 56 at least), which stay unless the longer string is repeated
    too; kept holds the remaining bytes (binary: a cut may fall within a character).  A null text is empty; repeated rows are copies of
    each other.  An empty table gives no rows; other columns are ignored.  Strings are compared byte by byte.  A text must fit a task.
    """
    short = min(short, size)
    if short < ANCHOR + 8:
        raise ValueError(f"size and short must be at least {ANCHOR + 8}")
    rows = X.grouped(docs)

    def ask(table: pa.Table) -> pa.Table:
        found = [Slice(part, short).anchor for part in slices(X.in_order(table), "text")]
        keys, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.table({"pid": pa.array(np.full(len(keys), table.column("pid")[0].as_py(), np.int32)), "key": pa.array(keys), "n": pa.array(n, pa.int64())})

    def records(table: pa.Table, hits: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in RECORDS.split(", ")]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
        if not table.num_rows or not hits.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        hits, fresh, numbers = hits.sort_by("key"), [], [np.empty(0, np.int64)]
        for _, _, _, _, number, new in _group_records(table, hits.column("key").to_numpy(), hits.column("m").to_numpy(), size, short):
            fresh += new
            numbers.append(number)
        many = np.bincount(np.concatenate(numbers), minlength=len(fresh)) > 1
        anchor, sub, place, n, content = zip(*fresh) if fresh else ((),) * 5
        lead = [int.from_bytes(c[p : p + 8], "big") - (1 << 63) for p, c in zip(place, content)]
        columns = [[table.column("pid")[0].as_py()] * len(lead), range(len(lead)), lead, anchor, sub, place, n, many, content]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in _with_end(batches):
            if batch is not None:
                held.append(batch)
                if sum(b.column("content").nbytes for b in held) < STEP_BYTES:
                    continue
            if not held:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            keys = [table.column(c).to_numpy() for c in ("lead", "anchor", "sub")]
            to = len(table)
            if batch is not None:  # the last run may go on
                cuts = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))
                to = int(cuts[-1]) + 1 if len(cuts) else 0
            if to:
                yield from _flagged(table.slice(0, to), size, short)
            held = table.slice(to).to_batches()

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated", "kept"]
        types = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.binary()]
        if not table.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        hits = answers.filter(answers.column("rec").is_null()).sort_by("key")
        marks = answers.filter(answers.column("rec").is_valid())
        short_of, long_of = ({r: m.as_buffer() for r, m in zip(marks.column("rec").to_pylist(), marks.column(c))} for c in ("short", "long"))
        ids, kept, columns = [], [], [[], [], [], []]
        for part, s, low, high, number, _ in _group_records(table, hits.column("key").to_numpy(), hits.column("m").to_numpy(), size, short):
            starts = {}
            for name, masks in (("short", short_of), ("long", long_of)):
                mine = [(a, b - a + 1, masks[r]) for a, b, r in zip(low.tolist(), high.tolist(), number.tolist()) if r in masks]
                starts[name] = np.concatenate([a + np.flatnonzero(np.unpackbits(np.frombuffer(m, np.uint8), count=n)) for a, n, m in mine] + [np.empty(0, np.int64)])
            gone, again = K.covered(starts["long"], size, len(s.buf)), K.covered(starts["short"], short, len(s.buf))
            head = gone.copy()
            head[1:] &= ~gone[:-1]
            firsts = s.offs[:-1][np.diff(s.offs) > 0]
            head[firsts] = gone[firsts]
            for c, values in zip(columns, (np.diff(s.offs), K.per_document(gone, s.offs), K.per_document(head, s.offs), K.per_document(again, s.offs))):
                c.append(values)
            left = s.buf[~gone].tobytes()
            cuts = np.concatenate(([0], np.cumsum(~gone)))[s.offs].tolist()
            kept += [left[a:b] for a, b in zip(cuts, cuts[1:])]
            ids += part.column("doc_id").to_pylist()
        digests = [hashlib.sha256(t).hexdigest() for t in kept]
        n_bytes, removed, spans, again = (np.concatenate(c) for c in columns)
        return pa.table([pa.array(c, t) for c, t in zip([ids, n_bytes, removed, spans, digests, again, kept], types)], names=names)

    asked = rows.groupBy("pid").applyInArrow(ask, "pid int, key long, n long")
    hits = asked.withColumn("m", F.sum("n").over(Window.partitionBy("key"))).where("m > 1").select("pid", "key", "m")
    sent = written(rows.groupBy("pid").cogroup(hits.groupBy("pid")).applyInArrow(records, RECORDS), "records")
    order = ["lead", "anchor", "sub"]
    flags = sent.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(compare, FLAGS)
    answers = hits.unionByName(flags.select("pid", "rec", "short", "long"), allowMissingColumns=True)
    return rows.groupBy("pid").cogroup(answers.groupBy("pid")).applyInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_repeated long, kept binary")


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _flagged(table: pa.Table, size: int, short: int) -> Iterator[pa.RecordBatch]:
    """Flags of the windows of some whole runs of records: rows of FLAGS for those that have any."""
    sub = table.column("sub").to_numpy().astype(np.int64)
    anchor = table.column("anchor").to_numpy() ^ K.mix(sub.view(np.uint64)).view(np.int64)  # classes are compared each
    n = table.column("n").to_numpy().astype(np.int64)
    contents = [np.frombuffer(c.as_buffer(), np.uint8) for c in table.column("content")]
    many = table.column("many").to_numpy(zero_copy_only=False).astype(bool)
    shorts, longs = repeated_windows(contents, anchor, table.column("place").to_numpy().astype(np.int64), n, many, size, short)
    bounds = np.concatenate(([0], np.cumsum(n)))
    some = np.flatnonzero(np.add.reduceat(shorts, bounds[:-1]) > 0) if len(n) else np.empty(0, np.int64)
    if len(some):
        masks = [[np.packbits(f[bounds[k] : bounds[k + 1]]).tobytes() for k in some] for f in (shorts, longs)]
        chosen = table.select(["pid", "rec"]).take(pa.array(some)).combine_chunks()
        yield pa.RecordBatch.from_arrays([chosen.column("pid").combine_chunks(), chosen.column("rec").combine_chunks(), pa.array(masks[0], pa.binary()), pa.array(masks[1], pa.binary())], names=["pid", "rec", "short", "long"])
