"""Helpers shared by the corpus operators: shared storage, sizing and Arrow batch handling."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.storage import new_path

#: Bytes of text that one vectorised step works on; bounds the memory of a task.
CHUNK_BYTES = 1 << 20
#: Bytes of text that one group of documents holds on average.
GROUP_BYTES = 4 << 20


#: For each open temporary(): the tables written within it.
_open: list[list[str]] = []


def written(df: DataFrame, name: str, stays: bool = False) -> DataFrame:
    """df, written as a Parquet table in the shared folder and read back: cuts the lineage and survives lost executors.

    Tables stay until the folder is cleared, as results may still read them; those written within temporary() go at its end, but for
    those that stay."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    if _open and not stays:
        _open[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession):
    """Tables that operators write within are removed at the end: whatever reads them must have been written by then."""
    _open.append([])
    try:
        yield
    finally:
        paths = spark._jvm.org.apache.hadoop.fs
        for path in _open.pop():
            at = paths.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def numbered(df: DataFrame, name: str, column: str = "row") -> DataFrame:
    """df with row, a number of each row that is the same in every pass: written once, since doc_ids may repeat or be null."""
    return written(df.withColumn(column, F.monotonically_increasing_id()), name)


def ranked(df: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """df with idx, the place of each row among those of its tree by ``order`` (nulls first; equal rows in any order), and n, how many those are.

    Rows are dealt to sorted ranges of all trees together, so that a common tree spreads over many; what is summed along a tree is one row a range.
    """
    rows = numbered(df, f"{name}-rows", "_number")
    keys = [tree, *order, "_number"]
    sorted_ = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_number").withColumn("at", F.monotonically_increasing_id())
    dealt = written(sorted_, f"{name}-ranges").withColumn("range", F.shiftright("at", 33))  # the number of the partition
    along = Window.partitionBy(tree).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy(tree, "range").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    parts = parts.select(tree, "range", "first", F.coalesce(F.sum("rows").over(along), F.lit(0)).alias("before"), F.sum("rows").over(Window.partitionBy(tree)).alias("n"))
    return dealt.join(parts, [tree, "range"]).withColumn("idx", F.col("at") - F.col("first") + F.col("before")).select(*df.columns, "idx", "n")


def text_groups(docs: DataFrame, text: str = "text", group_bytes: int = GROUP_BYTES) -> int:
    """Number of document groups so that each holds about group_bytes of text; follows the input."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(8, -(-total // group_bytes))


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about limit bytes (always at least one row)."""
    import numpy as np

    n = batch.num_rows
    if not n:
        return
    data = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(data), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < n:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def map_texts(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, column: str = "text") -> DataFrame:
    """mapInArrow in bounded slices of the text column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                out = step(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)
