"""Dense signals as blocks of values: a row has ``block`` neighbouring bins of a track, the last one of a track what is left.

Columns: keys, block_idx, values (array<double>).  Kernels work on whole blocks; what they need of a neighbour is sent as a short array, so a track of any
length is dealt block by block and never has a row for each bin.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.smoothing import gaussian_weights

#: Bins of one block.
BLOCK = 1 << 16


def key_fields(df: DataFrame, keys: tuple[str, ...]) -> list[str]:
    """Names and types of the keys, for the schema of an Arrow function."""
    return [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys]


def from_rows(signal: DataFrame, keys: tuple[str, ...] = ("chrom", "track"), block: int = BLOCK, sizes: DataFrame | None = None) -> DataFrame:
    """Blocks of a signal in rows (keys, bin, value): of a dense one; with sizes (keys[0], n_bins) of any, in which absent bins count as 0 and bins beyond the end go."""
    if sizes is not None:
        return _filled(signal, sizes, keys, block)
    rows = signal.groupBy(*keys, F.floor(F.col("bin") / block).alias("block_idx")).agg(F.array_sort(F.collect_list(F.struct("bin", F.col("value").cast("double").alias("value")))).alias("v"))
    return rows.select(*keys, "block_idx", F.transform("v", lambda s: s["value"]).alias("values"))


def _filled(signal: DataFrame, sizes: DataFrame, keys: tuple[str, ...], block: int) -> DataFrame:
    at = F.floor(F.col("bin") / block).alias("block_idx")
    rows = signal.select(*keys, at, "bin", F.col("value").cast("double").alias("value"), F.lit(None).cast("long").alias("n"))
    length = F.least(F.lit(block).cast("long"), F.col("n_bins") - F.col("block_idx") * block).alias("n")
    all_ = signal.select(*keys).distinct().join(sizes.where("n_bins > 0").select(keys[0], F.col("n_bins").cast("long").alias("n_bins")), keys[0])
    all_ = all_.withColumn("block_idx", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_bins") - 1) / block))))
    rows = rows.unionByName(all_.select(*keys, "block_idx", F.lit(None).cast("long").alias("bin"), F.lit(None).cast("double").alias("value"), length))

    def fill(key: tuple, table: pa.Table) -> pa.Table:
        names = [*keys, "block_idx", "values"]
        n = max((v for v in table.column("n").to_pylist() if v is not None), default=0)
        held = table.filter(table.column("n").is_null())
        bins, x = held.column("bin").to_numpy() - key[-1].as_py() * block, np.zeros(n)
        inside = bins < n
        x[bins[inside]] = held.column("value").fill_null(0.0).to_numpy()[inside]
        columns = [*(pa.array([k.as_py()] * (n > 0), k.type) for k in key), list_of([x] if n else [])]
        return pa.table(columns, names=names)

    schema = ", ".join([*key_fields(signal, keys), "block_idx long, values array<double>"])
    return rows.groupBy(*keys, "block_idx").applyInArrow(fill, schema)


def to_rows(blocks: DataFrame, keys: tuple[str, ...] = ("chrom", "track"), block: int = BLOCK) -> DataFrame:
    """A row a bin: keys, bin, value."""
    each = blocks.select(*keys, "block_idx", F.posexplode("values").alias("i", "value"))
    return each.select(*keys, (F.col("block_idx") * block + F.col("i")).alias("bin"), "value")


def values_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The arrays of a list column, without copying."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        yield flat[a:b].astype(np.float64, copy=False)


def list_of(arrays: list[np.ndarray]) -> pa.ListArray:
    sizes = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate([*arrays, np.empty(0)])))


def map_blocks(blocks: DataFrame, kernel: Callable[[np.ndarray], np.ndarray], keys: tuple[str, ...] = ("chrom", "track")) -> DataFrame:
    """Every block by itself through a kernel; blocks that come out empty go.  Nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [kernel(v) for v in values_of(batch.column("values"))]
            done = pa.RecordBatch.from_arrays([*(batch.column(k) for k in (*keys, "block_idx")), list_of(out)], names=[*keys, "block_idx", "values"])
            yield done.filter(pa.array([len(v) > 0 for v in out], pa.bool_()))

    schema = ", ".join([*key_fields(blocks, keys), "block_idx long, values array<double>"])
    return blocks.select(*keys, "block_idx", "values").mapInArrow(run, schema)


def pool(blocks: DataFrame, factor: int, block: int = BLOCK, keys: tuple[str, ...] = ("chrom", "track")) -> DataFrame:
    """Means of each ``factor`` bins, in blocks of block / factor; the last, partial tile of a track is dropped.  A factor of 1 or less changes nothing."""
    if factor <= 1:
        return blocks.select(*keys, "block_idx", "values")
    if block % factor:
        raise ValueError("a block must hold whole tiles")
    return map_blocks(blocks, lambda v: v[: len(v) // factor * factor].reshape(-1, factor).mean(1), keys)


def with_edges(blocks: DataFrame, reach: int, block: int = BLOCK, keys: tuple[str, ...] = ("chrom", "track")) -> DataFrame:
    """Adds left and right: the last ``reach`` values of the block before and the first of the one after, null where there is none."""
    if not 0 < reach <= block:
        raise ValueError("a block must be as long as the reach")
    n = F.size("values")
    tail = F.slice("values", F.greatest(n - reach + 1, F.lit(1)), F.lit(reach))
    left = blocks.select(*keys, (F.col("block_idx") + 1).alias("block_idx"), tail.alias("left"))
    right = blocks.where("block_idx > 0").select(*keys, (F.col("block_idx") - 1).alias("block_idx"), F.slice("values", 1, reach).alias("right"))
    return blocks.join(left, [*keys, "block_idx"], "left").join(right, [*keys, "block_idx"], "left")


def smooth(blocks: DataFrame, sigma: float = 3.0, block: int = BLOCK, keys: tuple[str, ...] = ("chrom", "track")) -> DataFrame:
    """Gaussian smoothing; the ends of a track are reflected (... x1 x0 | x0 x1 ...).  Only the edges of blocks go to their neighbours."""
    if sigma <= 0:
        return blocks.select(*keys, "block_idx", "values")
    weights = np.array(gaussian_weights(sigma))
    radius = len(weights) // 2
    none = np.empty(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v, left, right in zip(*(values_of(batch.column(c)) for c in ("values", "left", "right"))):
                whole = np.concatenate((left[-radius:] if len(left) else none, v, right[:radius] if len(right) else none))
                missing = (radius - min(len(left), radius), radius - min(len(right), radius))  # beyond an end of the track, or a short last block
                out.append(np.convolve(np.pad(whole, missing, "symmetric"), weights, "valid"))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in (*keys, "block_idx")), list_of(out)], names=[*keys, "block_idx", "values"])

    schema = ", ".join([*key_fields(blocks, keys), "block_idx long, values array<double>"])
    near = with_edges(blocks.select(*keys, "block_idx", F.col("values").cast("array<double>").alias("values")), radius, block, keys)
    return near.select(*keys, "block_idx", "values", "left", "right").mapInArrow(run, schema)
