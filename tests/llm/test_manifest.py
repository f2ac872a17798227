"""The Merkle manifest against a brute-force tree."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strandline.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(*row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((level[i - 1] if i % 2 else "", level[i + 1] if i % 2 == 0 and i + 1 < len(level) else ""))
        i //= 2
    return out


def brute(rows):
    languages = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    ordered = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r))) for x in languages}
    trees = {x: tree([leaf_of(*r) for r in ordered[x]]) for x in languages}
    top = tree([trees[x][-1][0] for x in languages])
    out = []
    for k, x in enumerate(languages):
        for i, r in enumerate(ordered[x]):
            path = siblings(trees[x], i) + siblings(top, k)
            h = leaf_of(*r)
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                h = leaf_of(*r[:3], r[3] + 1, r[4])
            for a, b in path:
                h = H(a + h + b)
            out.append((r[0], leaf_of(*r), trees[x][-1][0], top[-1][0], H("".join(a + b for a, b in path)), h, h == top[-1][0]))
    return out


def compare(spark, rows, depth):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("idx", "n", "tree", "block", "row", "hash", "path", "root")})
    got = sorted(map(tuple, manifest.verify_documents(df, depth=depth).collect()), key=str)
    assert got == sorted(brute(rows), key=str)
    return got


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 65])
def test_sizes_around_blocks(spark, n):
    """Blocks of 4 leaves, so that 65 rows have four stages."""
    compare(spark, [(d * 3, "s", "en", d, "text %d" % d) for d in range(n)], 2)


def test_awkward_rows(spark):
    """Null ids, fields and languages, repeated rows and ids, empty and long texts, a language that is empty, one that sorts by bytes."""
    rng = random.Random(3)
    rows = [(d, None if d % 5 == 0 else "s%d" % (d % 3), rng.choice(["en"] * 6 + ["de", "", None, "é", "z"]), None if d % 4 == 0 else d, None if d % 9 == 0 else "w %d" % d) for d in range(90)]
    rows += [(None, "s", "en", 1, "no id"), (None, "s", "en", 1, "no id"), (None, None, None, None, None), (7, "s", "en", 5, "again"), (7, "s", "en", 5, "again"), (7, "s", "en", 5, "other")]
    rows += [(200, "s", "en", 9, ""), (201, "s", "de", 9, "日本 " * 50_000)]
    got = compare(spark, rows, 2)
    assert any(not r[-1] for r in got) and sum(not r[-1] for r in got) < len(got) / 3
    assert got == compare(spark, rows, 8)


def test_empty(spark):
    assert manifest.verify_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_change_moves_the_root(spark):
    rows = [(d, "s", "en", d, "text %d" % d) for d in range(40)]
    root = lambda r: manifest.verify_documents(spark.createDataFrame(r, SCHEMA), depth=3).first()["root"]
    first = root(rows)
    assert first == root(rows[::-1]) and first != root(rows[:-1]) and first != root([*rows[:-1], (*rows[-1][:4], "changed")])
