"""Hard negatives against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import hard_negatives as R

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """Rows as a multiset: rows that share an id are told apart by their places."""
    kept = []
    for place, (i, v, label) in enumerate(rows):
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i % 7 == 0 else label, place))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in kept:
        if a[0] % 100:
            continue
        others = sorted(((-dot(a[1], b[1]), b[0]) for b in kept if b[3] != a[3] and b[2] == a[2]))[:5]
        negatives = sorted((-dot(a[1], b[1]), b[0]) for b in kept if b[2] != a[2])
        for p, pid in others:
            fits = [(n, nid) for n, nid in negatives if 30 * -p <= 100 * -n <= 90 * -p][:10]
            out += [(a[0], pid, k + 1, nid, -p, -n) for k, (n, nid) in enumerate(fits)]
    return sorted(out)


def compare(spark, rows, part_rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("row", "part", "v", "tree", "rank", "score", "run")})
    got = sorted(map(tuple, R.mine(df, part_rows).collect()))
    assert got == brute(rows)
    return got


def vectors(n, d, seed=1, labels=4, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, d))
    return [(k, (middle[k % centres] + rng.normal(size=d) * 0.6).astype(np.float32).tolist(), int(rng.integers(labels))) for k in range(n)]


@pytest.mark.parametrize("part_rows", [50, 1 << 15])
def test_small_parts_and_one_part(spark, part_rows):
    assert len(compare(spark, vectors(900, 12), part_rows)) > 200


def test_more_parts_than_boxes_at_the_top(spark, monkeypatch):
    """Runs of parts stand for several parts, of several labels."""
    monkeypatch.setattr(R, "TOP", 5)
    assert len(compare(spark, vectors(700, 6, seed=4), 40)) > 100


def test_awkward_rows(spark):
    """Nulls in every column, components that are null or not finite, vectors of several lengths, repeated rows, ties, one very common vector."""
    rng = random.Random(2)
    rows = [(k, [rng.choice([-0.5, 0.25, 0.5]) for _ in range(rng.choice([3, 4, 4, 4]))], rng.randrange(3)) for k in range(0, 600, 2)]
    rows += [(1000 + k, [0.5, 0.5, 0.5, 0.5], k % 3) for k in range(150)]
    rows += [(100, [0.5, 0.5, 0.25, 0.5], 1)] * 3 + [(None, [0.5] * 4, 1), (300, None, 1), (400, [0.5] * 4, None), (500, [0.5, float("nan")], 1), (501, [float("inf")] * 4, 1), (502, [None, 0.5], 2), (503, [], 1), (700, [], 2)]
    for part_rows in (30, 1 << 15):
        compare(spark, rows, part_rows)


def test_empty_and_alone(spark):
    assert compare(spark, [], 10) == [] and compare(spark, [(100, [1.0, 2.0], 3)], 10) == []
    assert compare(spark, [(100, [1.0, 2.0], 3), (1, [1.0, 2.0], 3), (2, [0.5, 0.9], 4)], 10) == [(100, 1, 1, 2, 327680, 150528)]


def test_tree_search_skips_boxes():
    """The queue ends early: of clustered vectors few pages are looked into."""
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.integers(-20, 20, (640, 8)) + c for c in rng.integers(-2000, 2000, (40, 8))]).astype(np.float64)
    ids = np.arange(len(v))
    tree = R.Tree(ids, ids, v, list(range(8)))
    q = v[:1]
    looked = []

    class Pages(np.ndarray):
        def __getitem__(self, k):
            if isinstance(k, slice):
                looked.append(k.start)
            return super().__getitem__(k)

    order = tree.ids.copy()
    scores = dict(zip(order.tolist(), (tree.v @ q[0]).astype(int).tolist()))
    bounds = tree.bounds(q)
    tree.v = tree.v.view(Pages)
    best = tree.search(q[0], [(a[0], b[0]) for a, b in bounds], [(R.NOWHERE, -R.NOWHERE)], [R.NOWHERE], 5, 0)[0]
    assert [(s, -i) for s, i, _ in best] == sorted(((s, i) for i, s in scores.items() if i), key=lambda x: (-x[0], x[1]))[:5]
    assert len(looked) < len(v) / R.PAGE / 4
