"""From raw documents to shards: quality rules, near duplicates, benchmark decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the shared folder and reads it
again for the next stage.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import decontamination, mixing, near_duplicates, quality, sharding
from strandline.llm.common import numbered, temporary, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near duplicates share 0.8 of their five-word shingles.
SHINGLE, LINK = 5, (80, 100)
SHARDS = 8


#: Stands for doc_id while an operator judges: a number of the row, so that rows that share an id, or have none, are told apart.
KEY = "_row_key"


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with KEY, written once for a stage, so that every pass sees the same numbers."""
    return numbered(docs.select(*COLUMNS), "keyed", KEY)


def _as_id(keyed: DataFrame) -> DataFrame:
    return keyed.select(F.col(KEY).alias("doc_id"), "text")


def _with_keys(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose key is among keys: few are broadcast (8 bytes each), more joined by shuffling the rows."""
    chosen = written(keys, "chosen")
    few = chosen.count() <= near_duplicates.BROADCAST_IDS
    return keyed.join(F.broadcast(chosen) if few else chosen, KEY, "left_semi").select(*COLUMNS)


def _kept(keyed: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The rows that have a kept verdict."""
    return _with_keys(keyed, verdicts.where("kept").select(F.col("doc_id").alias(KEY)))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the forest reject go.

    Null and empty texts have no words, so they go; labels count for every row of their doc_id; repeated rows share their verdict; an empty
    table gives no rows; further columns are dropped.  Texts of any length are judged whole.
    """
    keyed = _keyed(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    marks = labels.join(keyed.select("doc_id", KEY), "doc_id").select(F.col(KEY).alias("doc_id"), "quality")
    return _kept(keyed, quality.judge_documents(_as_id(keyed), marks))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: one with the smallest doc_id (null last), of several the one that comes first.

    Of repeated rows one stays, too; rows without words are in no group and all stay; an empty table gives no rows; further columns are dropped.
    """
    keyed = _keyed(docs)
    found = near_duplicates.near_duplicates(_as_id(keyed), SHINGLE, LINK).select(F.col("doc_id").alias(KEY), "component_id", "n_shingles")
    rows = found.join(keyed.select(KEY, "doc_id"), KEY)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", KEY)
    first = rows.where("n_shingles > 0").groupBy("component_id").agg(F.min_by(KEY, order).alias(KEY)).select(KEY)
    return _with_keys(keyed, first.unionByName(rows.where("n_shingles = 0").select(KEY)))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none and stay; repeated rows share their verdict; an empty table gives no rows; further columns are dropped.
    """
    keyed = _keyed(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _kept(keyed, decontamination.tile_benchmark(_as_id(keyed), benchmark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights: a document stands as often as the mix takes it, at most twice.

    Whole documents only: one of which the mix takes a part stands once more if that is half of it or more, and one without
    words never.  Rows without a source are a source of their own; repeated rows are taken each; an empty table gives no rows; further columns
    are dropped.
    """
    mixed = mixing.mix_documents(docs, keep=tuple(COLUMNS))
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    return mixed.withColumn("again", F.explode(F.array_repeat(F.lit(1), times))).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row of the mix gets its shard and its place there; a document that the mix has twice gets two.  Rows without an id are spread by their texts, a null text
    counts as none; an empty table gives no rows; further columns are ignored."""
    return sharding.shard_documents(docs, SHARDS)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix_sources),
    ("sharding", shard),
]

#: SQL can't express the isolation forest of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with temporary(spark):  # what the stage's operator wrote goes once the stage's result stands
            docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}", stays=True)
    return docs
