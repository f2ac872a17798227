"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder in local mode and an error on a cluster."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table of the shared folder: evaluated once, and kept when executors are lost."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def noted(seen: Observation, name: str, without: object = None) -> object:
    """A value of an observation once its job has run; ``without`` where Spark found no row to look at, and so noted nothing."""
    try:
        value = seen.get[name]
    except Py4JJavaError:
        return without
    return without if value is None else value


def written_noting(df: DataFrame, name: str, value: Column) -> tuple[DataFrame, object]:
    """written(), and an aggregate of the rows that is taken on the way."""
    seen = Observation()
    return written(df.observe(seen, value.alias("value")), name), noted(seen, "value")
