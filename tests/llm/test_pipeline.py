"""The pipeline against a brute-force version, and the registered SQL twin."""

from __future__ import annotations

import os
import sys
from collections import Counter

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from strandline.llm import queries  # noqa: E402
from tests.llm.test_operators import brute_components, corpus  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark, tmp_path):
    item = " ".join("item%d" % k for k in range(30))
    rows = [r for r in corpus(80) if r[0] is not None][:-1] + [(500, "before it " + item + " and some more words after it so that the rule of twenty holds", "en", "src1", 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, int(d % 8 != 3), 0) for d in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        kept.append(docs)
        if name != "sharding":
            assert docs.columns == corpus_pipeline.COLUMNS
    after = [sorted(r["doc_id"] for r in d.collect()) for d in kept]
    text = {r[0]: r[1] for r in rows}
    good = [(d, text[d]) for d in after[0]]
    expect = {d for d, found in brute_components(good, 5, (80, 100)).items() if any(c == d for _, c in found)}
    assert set(after[1]) == expect
    assert set(after[2]) == expect - {500} and 500 in expect
    assert set(after[3]) <= set(after[2]) and max(Counter(after[3]).values()) <= 2
    assert after[4] == after[3]
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r["doc_id"] for r in out.collect()) == after[4]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_mix_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    expect = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()['op2_mixing']})").fetchall()
    got = [tuple(r) for r in queries.queries()["op2_mixing"](spark, SF).select(*columns).collect()]
    assert sorted(got) == sorted(expect)


def test_stages_with_awkward_rows(spark, tmp_path):
    """Null and repeated ids, repeated rows, null sources, clashing and further columns, then nothing at all, in every stage."""
    item = " ".join("item%d" % k for k in range(30))
    good = lambda w: " ".join("%s%d" % (w, k) for k in range(60))
    rows = [
        (1, good("a"), "en", None, 1), (1, good("a"), "en", None, 1), (1, "short", "en", "s", 1), (None, good("b"), None, "s", None), (None, good("b"), None, "s", None), (None, "short", "en", "s", 1),
        (None, good("c") + " " + item, "en", "t", 1), (2, good("b") + " more", "en", "t", 1), (3, None, None, None, None), (4, "", "en", "s", 0), (5, good("d"), "en", None, 1), (5, good("e"), "en", None, 1),
    ]
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (None, "x"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, SCHEMA)
    more = docs.selectExpr("*", "'clash' AS row", "'clash' AS component", "'clash' AS key", "'clash' AS size", "'clash' AS kept", "'clash' AS rank")
    stages = dict(corpus_pipeline.STAGES)
    alike = lambda df: sorted(map(str, df.collect()))
    for name, stage in stages.items():
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
        assert alike(stage(spark, more, str(tmp_path))) == alike(stage(spark, docs, str(tmp_path))), name
    after = stages["quality rules"](spark, docs, str(tmp_path))
    assert all(len((r["text"] or "").split()) >= 20 for r in after.collect())
    kept = [(r["doc_id"], r["text"]) for r in stages["near duplicates"](spark, docs, str(tmp_path)).collect()]
    assert Counter(kept) == Counter([(1, good("a")), (1, "short"), (2, good("b") + " more"), (None, good("c") + " " + item), (3, None), (4, ""), (5, good("d")), (5, good("e"))])
    left = stages["benchmark decontamination"](spark, docs, str(tmp_path)).collect()
    assert len(left) == len(rows) - 1 and all(item not in (r["text"] or "") for r in left)


def test_stages_with_a_very_long_text(spark, tmp_path):
    """A text of some megabytes is judged whole: its near copy goes, the item at its very end is found, and it takes its place among shards."""
    import random

    rng = random.Random(4)
    item = " ".join("item%d" % k for k in range(30))
    long = " ".join("w%d" % rng.randrange(50_000) for k in range(300_000))
    rows = [(1, long, "en", "s", 1), (2, long + " more", "en", "s", 1), (3, long[:200_000] + " " + item, "en", "t", 1)] + [(d, " ".join("v%d" % rng.randrange(900) for _ in range(60)), "en", "t", 1) for d in range(4, 12)]
    spark.createDataFrame([(d, int(d < 10), 0) for d in range(12)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, SCHEMA)
    ids = lambda name: sorted(r["doc_id"] for r in dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path)).collect())
    assert {1, 2, 3} <= set(ids("quality rules"))
    assert ids("near duplicates") == [1, *range(3, 12)]
    assert ids("benchmark decontamination") == [1, 2, *range(4, 12)]
    assert ids("sharding") == list(range(1, 12)) and len(ids("mixing sources")) >= 9


def test_run_removes_what_stages_wrote(spark, tmp_path):
    item = " ".join("item%d" % k for k in range(30))
    spark.createDataFrame([(d, " ".join("w%d" % (k * d % 97) for k in range(60)), "en", "s%d" % (d % 3), 1) for d in range(1, 30)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, d % 2, 0) for d in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert all(n.startswith("stage-") for n in set(os.listdir(shared)) - before) and out.count() >= 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", ["op4_near_duplicates", "op6_word_spans", "op9_byte_spans"])
def test_columns_equal_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = queries.queries()[name](spark, SF)
    result = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, result.fetchall()))
