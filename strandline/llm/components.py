"""Connected components of a link table; nothing is collected.

Each task contracts its own links to stars around the smallest node.  If the links fit one task's bound they are then one
partition, and that is the answer.  Otherwise rounds of large and small stars go on between tasks: each node links its larger
neighbours to the smallest node near it, then its smaller ones; both keep the components, shrink the table, and are grouped minima and
joins on the node, which Spark can split where a node has very many links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import written

#: Most links that one task contracts (16 bytes each).
TASK_LINKS = 2_000_000


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node that isn't its component's smallest, and that smallest node."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches if b.num_rows]
    if parts:
        u, v = contract(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _star_round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.where("v > u").join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
    near = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return small.unionByName(near.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """node, component (the smallest node that can be reached) for every node of links (a, b)."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v"), "edges")
    state = None
    while True:
        n = edges.count()
        parts = max(1, -(-n // task_links))
        edges = written(edges.coalesce(parts).mapInArrow(_contracted, "u long, v long"), "edges")
        if parts == 1:
            break
        edges = written(_star_round(edges), "edges")
        before, state = state, tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())
        if state == before:
            break
    ends = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return ends.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
