"""Vectorised byte and word kernels used inside Arrow tasks.

Texts are handled as one UTF-8 buffer with document offsets.  Words are maximal runs of bytes
other than space and \\t..\\r, so they agree with ``[^\\x20\\x09-\\x0D]+`` on characters.
Fingerprints are polynomials modulo the prime 2**61 - 1, read from prefix sums: a span costs O(1).  Two different spans of n
items agree with a chance of n / 2**61 at most, whatever their structure (a modulus of 2**64 would not do: there a Thue-Morse word
and its complement agree for every base).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
P61 = (1 << 61) - 1
_BASE = 0x9E3779B97F4A7C15 % P61
_INVERSE = pow(_BASE, -1, P61)
#: Items of one step of arithmetic.
STEP = 1 << 13
_P, _M31, _M30 = U(P61), U((1 << 31) - 1), U((1 << 30) - 1)
_rng = np.random.Generator(np.random.PCG64(20240229))
#: Random value of each byte.
BYTE = _rng.integers(1, P61, 256, dtype=np.uint64)
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, 9, 10, 11, 12, 13]] = False
#: Letters, digits and all bytes outside ASCII.
IS_ALNUM = np.zeros(256, bool)
IS_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _reduce(x: np.ndarray) -> np.ndarray:
    """x modulo 2**61 - 1, in place."""
    high = x >> U(61)
    x &= _P
    x += high
    np.add(x, U(1), out=high)
    high >>= U(61)
    x += high
    x &= _P
    return x


def _product(a: np.ndarray, b: np.ndarray, out: np.ndarray) -> None:
    a1, b1 = a >> U(31), b >> U(31)
    a0, b0 = a & _M31, b & _M31
    middle = a1 * b0
    np.multiply(a1, b1, out=out)
    out <<= U(1)
    middle += a0 * b1
    a0 *= b0
    out += a0
    np.right_shift(middle, U(30), out=a0)
    out += a0
    middle &= _M30
    middle <<= U(31)
    out += middle
    _reduce(out)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2**61 - 1, for values below it: from halves of 31 bits, since 2**61 counts as 1.  In steps that fit the cache."""
    out = np.empty(len(a), np.uint64)
    for k in range(0, len(a), STEP):
        to = k + STEP
        _product(a[k:to], b if len(b) == 1 else b[k:to], out[k:to])
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**61 - 1."""
    global _powers, _inverses
    while len(_powers) < n:
        k = len(_powers)
        _powers = np.concatenate((_powers, product(_powers, np.array([pow(_BASE, k, P61)], np.uint64))))
        _inverses = np.concatenate((_inverses, product(_inverses, np.array([pow(_INVERSE, k, P61)], np.uint64))))
    return _powers[:n], _inverses[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def words(buf: np.ndarray, offs: np.ndarray, member: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each document the number of words before it (length documents + 1)."""
    if not len(buf):
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(offs), np.int64)
    inside = member[buf]
    before = np.empty(len(buf), bool)
    before[0] = False
    before[1:] = inside[:-1]
    heads = offs[:-1]
    before[heads[heads < len(buf)]] = False
    after = np.empty(len(buf), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    tails = offs[1:] - 1
    after[tails[tails >= 0]] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, offs)


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of value * base**position, with a leading 0.  Values are below 2**64; of those above 61 bits the last 3 don't count."""
    sums, power, total = np.zeros(len(values) + 1, np.uint64), powers(len(values))[0], 0
    for k in range(0, len(values), STEP):
        part = values[k : k + STEP].astype(np.uint64)
        wide = part >= _P
        if wide.any():
            part[wide] >>= U(3)
        terms = sums[k + 1 : k + 1 + len(part)]
        _product(part, power[k : k + len(part)], terms)
        low = np.cumsum(terms & _M31)  # neither sum exceeds 62 bits
        terms >>= U(31)
        np.cumsum(terms, out=terms)
        high = terms >> U(30)
        low += high
        terms &= _M30
        terms <<= U(31)
        terms += low
        _reduce(terms)
        terms += U(total)
        _reduce(terms)
        total = int(terms[-1])
    return sums


def span(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of the spans [start, end), spread over 64 bits."""
    inverse, out = powers(len(sums))[1], np.empty(len(start), np.uint64)
    for k in range(0, len(start), STEP):
        first = start[k : k + STEP]
        d = sums[end[k : k + STEP]]
        d += _P
        d -= sums[first]
        part = out[k : k + STEP]
        _product(_reduce(d), inverse[first], part)
        part[:] = mix(part)
    return out


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return span(prefix(BYTE[buf]), start, end)


def runs(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenation of the ranges first[i] .. first[i] + count[i] - 1."""
    count = np.maximum(count, 0)
    total = int(count.sum())
    if not total:
        return np.empty(0, np.int64)
    shift = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count)
    return shift + np.arange(total)


def windows(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start (as a word number) and fingerprint of every window of size words within one document."""
    at = runs(bounds[:-1], np.diff(bounds) - size + 1)
    sums = prefix(hashes)
    return at, span(sums, at, at + size)


def covered(at: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n places lie in a window that starts at one of at."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, at, 1) if len(at) < 1000 else steps.__iadd__(np.bincount(at, minlength=n + 1).astype(np.int32))
    ends = at + size
    steps -= np.bincount(ends, minlength=n + 1).astype(np.int32)[: n + 1]
    return np.cumsum(steps[:-1]) > 0


def per_document(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values in each range bounds[i] .. bounds[i + 1]."""
    total = np.concatenate(([0], np.cumsum(values.astype(np.int64))))
    return total[bounds[1:]] - total[bounds[:-1]]


def owners(bounds: np.ndarray) -> np.ndarray:
    """Document number of each element."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def first_seen(keys: np.ndarray) -> np.ndarray:
    """For each element, the index of the first element with the same key."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    out = np.empty(len(keys), np.int64)
    out[order] = order[head]
    return out
