"""How documents are dealt to groups, above all rows that are equal."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.llm import byte_spans, exchange, word_spans


def test_equal_rows_are_dealt_apart(spark):
    """A hundred thousand equal rows, as many with no id, and one line that all have."""
    line = "one line that every row has, word for word, from the first to the last of its twenty and some more words in all"
    equal = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(line).alias("text"))
    rows = equal.unionByName(equal.withColumn("doc_id", F.lit(None).cast("long"))).unionByName(spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit(line), F.col("id").cast("string")).alias("text")))
    dealt = exchange.grouped(rows, 1 << 18)
    sizes = [r["n"] for r in dealt.groupBy("pid").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 220_000 and max(sizes) < 2 * sum(sizes) / len(sizes) and len(sizes) > 60
    again = {(r["pid"], r["doc_id"]): r["n"] for r in dealt.groupBy("pid", "doc_id").count().withColumnRenamed("count", "n").where("doc_id = 7 OR doc_id IS NULL").collect()}
    assert again == {(r["pid"], r["doc_id"]): r["n"] for r in exchange.grouped(rows.repartition(3), 1 << 18).groupBy("pid", "doc_id").count().withColumnRenamed("count", "n").where("doc_id = 7 OR doc_id IS NULL").collect()}


@pytest.mark.parametrize("most", [500_000, 0])
def test_other_columns_and_null_texts(spark, monkeypatch, most):
    monkeypatch.setattr(exchange, "BROADCAST_KEYS", most)
    rows = [(1, "a", True), (1, "a", False), (1, "a", True), (None, None, True), (None, "", True), (None, None, False), (2, "b", None), (2, "b", None), (3, "c", True)]
    got = exchange.grouped(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean"), others=("held_out",)).collect()
    assert Counter((r["doc_id"], r["text"], r["held_out"]) for r in got) == Counter((d, t or "", h) for d, t, h in rows)


def test_repeated_rows_in_the_operators(spark):
    """Forty copies of a text in small groups: the first keeps its words, none keeps its bytes."""
    text = " ".join("w%d" % k for k in range(120))
    df = spark.createDataFrame([(5, text)] * 40 + [(None, text)] * 3 + [(9, text + " more"), (10, "short text")], "doc_id long, text string")
    words = sorted(r["n_removed"] for r in word_spans.remove_repeats(df).collect())
    assert words == [0, 0, *[120] * 43]
    assert sorted(r["n_removed"] for r in byte_spans.remove_repeats(df).collect()) == sorted([0, *[len(text)] * 44])


def test_a_group_is_never_cut(monkeypatch):
    table = pa.table({"doc_id": [2, None, 1], "h": [1, 2, 3], "text": ["b", "n", "a"]})
    assert exchange.in_order(table).column("text").to_pylist() == ["a", "b", "n"]
    with pytest.raises(ValueError):
        exchange.in_order(table.slice(0, 0))
