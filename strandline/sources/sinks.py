"""Writers of token tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strandline.sources.files import located
from strandline.storage import noted

TSV_ROWS = 10_000


def write_tokens(tokens: DataFrame, path: str, partitions: tuple[str, ...] = ("chrom",), order: tuple[str, ...] = ("token_id",), tsv: bool = True) -> None:
    """Parquet by partition, of which only those present are replaced, and the first TSV_ROWS rows as a readable table.

    tokens are evaluated once: the readable rows come from what was written.  Rows are brought together by partition, a large one in several tasks (and files) of
    spark.sql.adaptive.advisoryPartitionSizeInBytes.  The partitions that were written, as many as folders, are noted on the way.
    """
    seen = Observation()
    watched = tokens.observe(seen, F.collect_set(F.struct(*partitions)).alias("partitions"))
    writer = watched.hint("rebalance", *partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(f"{path}/tokens")
    if tsv:
        back = read_tokens(tokens.sparkSession, path, tokens)
        same = lambda p: reduce(Column.__and__, (F.col(c).eqNullSafe(F.lit(p[c])) for c in partitions))
        fresh = reduce(Column.__or__, map(same, noted(seen, "partitions", [])), F.lit(False))
        back.where(fresh).orderBy(*order).limit(TSV_ROWS).write.mode("overwrite").csv(f"{path}/tsv", sep="\t", header=True)


def committed(spark: SparkSession, path: str, keys: tuple[str, ...], like: DataFrame) -> DataFrame:
    """The partitions of a table that are whole (keys, n_rows): those that its manifest names."""
    schema = ", ".join([*(f"`{k}` {like.schema[k].dataType.simpleString()}" for k in keys), "n_rows long"])
    system, at = located(f"{path}/manifest")
    if system.get_file_info(at).type.name == "NotFound":
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/manifest").groupBy(*keys).agg(F.max("n_rows").alias("n_rows"))


def write_missing(rows: DataFrame, path: str, keys: tuple[str, ...] = ("chrom",)) -> DataFrame:
    """Rows of the partitions that aren't committed yet, written by partition; then they are committed: a line a partition in the manifest, after all data.

    What a killed run left behind is in no manifest, so the next run replaces it: each partition stands once, whole.  Returns the partitions written now.  rows are evaluated once,
    and of them only those partitions that are missing (an anti join on keys, which reaches a source that is dealt by them).  What is committed is broadcast: a join that deals rows by
    keys would bring each partition to one task, which the rebalancing before the write could not split.
    """
    spark = rows.sparkSession
    done = F.broadcast(committed(spark, path, keys, rows).select(*keys))  # as many as folders
    todo = rows.join(done, list(keys), "left_anti")
    seen = Observation()
    watched = todo.observe(seen, F.collect_set(F.struct(*keys)).alias("partitions"))
    writer = watched.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(f"{path}/data")
    now = spark.createDataFrame(noted(seen, "partitions", []), ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys))  # as many as folders
    kept = spark.read.schema(rows.schema).parquet(f"{path}/data").join(F.broadcast(now), list(keys), "left_semi").groupBy(*keys).agg(F.count("*").alias("n_rows"))
    kept.write.mode("append").parquet(f"{path}/manifest")
    return now


def read_committed(spark: SparkSession, path: str, keys: tuple[str, ...], like: DataFrame) -> DataFrame:
    """The rows of committed partitions alone."""
    rows = spark.read.schema(like.schema).parquet(f"{path}/data").select(*like.columns)
    return rows.join(F.broadcast(committed(spark, path, keys, like)), list(keys), "left_semi")


def read_tokens(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """All partitions together, with the columns and types of ``like`` if given."""
    return spark.read.schema(like.schema).parquet(f"{path}/tokens").select(*like.columns) if like is not None else spark.read.parquet(f"{path}/tokens")


def write_summary(summary: DataFrame, path: str) -> None:
    if not summary.isEmpty():
        summary.write.mode("overwrite").csv(path, sep="\t", header=True)
