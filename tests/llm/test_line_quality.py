"""The line chain against sums over all labellings, and its scores on documents whose good and bad lines are known."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.llm import line_quality as L

WORDS = ["alpha", "bread", "cloud", "drift", "ember", "field", "grain", "house", "inlet", "jolly", "known", "light", "mouse", "north", "other", "point"]


def problem(seed=1):
    rng = np.random.default_rng(seed)
    return L.Chain(rng.normal(size=5), rng.normal(size=(2, 2))), rng.normal(size=(9, 5)), np.array([0, 3, 3, 4, 9]), rng.integers(0, 2, 9)


def test_marginals_are_sums_over_labellings():
    chain, x, lines, _ = problem()
    expect, logs = np.zeros(9), []
    for a, b in zip(lines[:-1], lines[1:]):
        total = 0.0
        for s in itertools.product((0, 1), repeat=int(b - a)):
            weight = np.exp(sum((x[a + i] @ chain.weights) * (s[i] - 0.5) for i in range(b - a)) + sum(chain.pairs[s[i - 1], s[i]] for i in range(1, b - a)))
            total += weight
            expect[a:b] += weight * np.array(s)
        expect[a:b] /= total
        logs.append(np.log(total))
    assert np.allclose(chain.marginals(x, lines), expect)
    assert np.allclose(chain.messages(x, lines)[3], logs)


def test_gradient():
    chain, x, lines, y = problem(2)
    point = np.concatenate((chain.weights, chain.pairs.ravel()))
    loss = lambda p: L.Chain(p[:5], p[5:].reshape(2, 2)).loss(x, lines, y)[0]
    steps = [(loss(point + d) - loss(point - d)) / 2e-5 for d in np.eye(9) * 1e-5]
    assert np.allclose(steps, chain.loss(x, lines, y)[1], atol=1e-6)


def test_long_chains_stay_finite():
    """100,000 lines of strong weights."""
    x = np.tile([[50.0], [-50.0]], (50_000, 1))
    good = L.Chain(np.ones(1), np.array([[5.0, -5.0], [-5.0, 5.0]])).marginals(x, np.array([0, 100_000]))
    assert np.isfinite(good).all() and (good[::2] > 0.9).all() and (good[1::2] < 0.1).all()


def test_minimise():
    a = np.diag([1.0, 10.0, 100.0])
    assert np.allclose(L.minimise(lambda v: (0.5 * v @ a @ v - v.sum(), a @ v - 1), np.zeros(3)), [1, 0.1, 0.01], atol=1e-3)


def test_statistics_of_lines():
    x, lines, length = L.line_statistics(pa.array(["One two\n\n  \nTWO! two | x", None, "", "a a a"]))
    assert lines.tolist() == [0, 2, 2, 2, 3] and length.tolist() == [6, 9, 3]
    row = dict(zip(L.STATS, x[1]))
    assert row["upper"] == 3 / 7 and row["exclamations"] == 1 / 4 and row["bars"] == 1 / 4 and row["stutter"] == 0 and row["ends"] == 0
    assert dict(zip(L.STATS, x[2]))["stutter"] == 2 / 3 and np.isclose(dict(zip(L.STATS, x[2]))["distinct"], 1 / 3)
    features = L.neighbours(x, lines)
    d = len(L.STATS)
    assert (features[0, d : 2 * d] == 0).all() and (features[0, 2 * d : 3 * d] == x[1]).all() and (features[1, d : 2 * d] == x[0]).all() and (features[2, d : 3 * d] == 0).all()
    assert features[:, -3:].tolist() == [[1, 0, 1], [0, 1, 1], [1, 1, 1]]


def corpus(n=300, seed=5):
    rng = random.Random(seed)
    say = lambda k: " ".join(rng.choice(WORDS) + rng.choice(["", "", ","]) for _ in range(k)).capitalize() + "."
    junk = [lambda: " | ".join(rng.choice(WORDS) for _ in range(12)), lambda: say(12).upper() + "!!", lambda: " ".join([rng.choice(WORDS)] * 15), lambda: say(12).replace(" ", "### ")]
    docs, labels = [], []
    for d in range(n):
        bad = d % 4 == 0
        lines = [say(rng.randint(6, 20)) for _ in range(rng.randint(1, 6))]
        if bad:
            kind = junk[(d // 4) % 4]
            lines += [kind() for _ in range(3 * len(lines) + 2)]
        docs.append((d, "\n".join(lines)))
        labels.append((d, 0 if bad else 1))
    return docs, labels


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = corpus()
    extra = [(1000, None), (1001, ""), (1002, " \n\t"), (None, "no id here at all."), (1003, "### $$$ | !! " * 20_000), (5, docs[5][1]), (5, docs[5][1])]
    df = spark.createDataFrame(docs + extra, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("score", "quality", "held_out", "x", "length")})
    marks = spark.createDataFrame([*labels, (None, 1), (5000, 0), (7, None)], "doc_id long, quality int")
    return docs, dict(labels), L.score_documents(df, marks).collect()


def test_held_out_documents(scored):
    _, labels, rows = scored
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 60 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows if r["doc_id"] is not None)
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_awkward_rows(scored):
    docs, _, rows = scored
    assert len(rows) == len(docs) + 7
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert {r["score"] for d in (1000, 1001, 1002) for r in by[d]} == {by[1000][0]["score"]} and by[1000][0]["good_share"] is None
    assert len(by[5]) == 3 and len({r["score"] for r in by[5]}) == 1
    assert by[1003][0]["predicted"] == 0 and by[None][0]["held_out"] is False


def test_lines_are_told_apart(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = L.fit(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    mixed = "\n".join([docs[1][1].split("\n")[0]] * 1 + ["alpha | bread | cloud | drift | ember | field | grain | house"] * 4)
    good = L.score_lines(spark.createDataFrame([(1, mixed), (2, None)], "doc_id long, text string"), model).collect()
    assert good[0]["good"][0] > 0.5 > max(good[0]["good"][2:]) and good[1]["good"] == []


def test_fitting_is_bounded_and_needs_both_labels(spark):
    docs, labels = corpus()
    df, marks = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    assert L.fit(df, marks, rows=40) is not None and L.fit(df, marks.where("quality = 1")) is None
    assert {r["score"] for r in L.score_documents(df, marks.where("quality = 1")).collect()} == {0.5}
    assert L.score_documents(df.limit(0), marks).collect() == []
