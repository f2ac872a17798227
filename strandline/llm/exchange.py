"""Groups of documents, and the questions that they ask of each other by key.

Documents are dealt to groups of some megabytes by a hash of doc_id and text.  A group works out keys of its documents and asks with
one row for each distinct one; Spark shuffles the rows by key and answers with the rows of those keys that matter.  The group then takes up its
documents again and finds the keys that came back.  Rows grow in proportion to the text.  A very common key counts once in each group, in
narrow rows that a window over the key can spill.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import GROUP_BYTES, written

#: Most keys of repeated rows (some 30 bytes each) that every task has.
BROADCAST_KEYS = 500_000


def grouped(docs: DataFrame, group_bytes: int = GROUP_BYTES, others: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, others, h, pid): h is a hash of the text, pid the group.  Null ids and rows that share an id are spread by their texts.

    Rows that are equal in all of these are dealt one by one, too: of each, one is kept and multiplied by its number, and the copies, which nothing tells
    apart, are spread by their places among them.  So groups stay near group_bytes, and every pass deals alike.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *others).withColumn("h", F.xxhash64("text"))
    keys = ["doc_id", "h", *others]
    counts = rows.select(*keys, F.octet_length("text").alias("size")).groupBy(*keys).agg(F.count("*").alias("copies"), F.sum("size").alias("size"))
    counts = written(counts, "copies")
    again = counts.where("copies > 1")
    total, n_again = counts.agg(F.sum("size"), F.sum((F.col("copies") > 1).cast("long"))).first()
    n = max(8, -(-(total or 0) // group_bytes))
    if n_again:
        few = F.broadcast if n_again <= BROADCAST_KEYS else lambda d: d  # checked; more are joined by shuffling
        named = few(again.select(*(F.col(k).alias(f"_{k}") for k in keys), "copies"))
        same = reduce(Column.__and__, (rows[k].eqNullSafe(F.col(f"_{k}")) for k in keys))
        once = rows.join(named, same, "left_anti").withColumn("copy", F.lit(0).cast("long"))
        each = rows.join(named, same).drop(*(f"_{k}" for k in keys)).dropDuplicates(keys)
        rows = once.unionByName(each.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies"))
    else:
        rows = rows.withColumn("copy", F.lit(0).cast("long"))
    place = F.when(F.col("copy") == 0, F.xxhash64("doc_id", "h")).otherwise(F.xxhash64("doc_id", "h", "copy"))
    return rows.withColumn("pid", F.pmod(place, F.lit(n)).cast("int")).drop("copy")


def in_order(table: pa.Table) -> pa.RecordBatch:
    """The documents of a group by doc_id (null last), then by the hash of the text, as one batch."""
    batches = table.sort_by([("doc_id", "ascending"), ("h", "ascending")]).combine_chunks().to_batches()
    if len(batches) > 1:  # more text than one string array can address
        at = table.schema.get_field_index("text")
        wide = pa.Table.from_batches(batches)
        batches = wide.set_column(at, "text", wide.column("text").cast(pa.large_string())).combine_chunks().to_batches()
    if len(batches) != 1:
        raise ValueError("a group of documents does not fit one batch" if batches else "a group without documents")
    return batches[0]


def found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are among the wanted ones (sorted), and where there."""
    if not len(wanted):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
    return wanted[at] == keys, at
