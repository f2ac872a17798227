"""Gaussian smoothing of binned signals."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of one block.
BLOCK = 1 << 14


def gaussian_weights(sigma: float, truncate: float = 4.0) -> list[float]:
    radius = int(truncate * sigma + 0.5)
    w = [math.exp(-k * k / (2 * sigma * sigma)) for k in range(-radius, radius + 1)]
    return [x / sum(w) for x in w]


def gaussian_smooth(signal: DataFrame, sizes: DataFrame, sigma: float = 3.0, keys: tuple[str, ...] = ("chrom", "track"), block: int = BLOCK) -> DataFrame:
    """A dense signal (keys, bin, value), smoothed; edges are reflected (... x1 x0 | x0 x1 ...).  sizes: keys[0], n_bins.

    A task convolves blocks of bins; only the bins within reach of a block's edge are sent to both sides, and those near an end of the
    track also stand at their mirror images.  Absent bins count as 0.
    """
    if sigma <= 0:
        return signal.select(*keys, "bin", "value")
    weights = np.array(gaussian_weights(sigma))
    radius = len(weights) // 2
    n, period = F.col("n_bins"), 2 * F.col("n_bins")
    turns = F.sequence(-F.ceil(radius / period) - 1, F.ceil(radius / period) + 1)
    images = F.flatten(F.transform(turns, lambda m: F.array(F.col("bin") + m * period, m * period - F.col("bin") - 1)))
    near_end = (F.col("bin") < radius) | (F.col("bin") >= n - radius)
    places = F.when(near_end, F.filter(images, lambda p: (p >= -radius) & (p < n + radius))).otherwise(F.array("bin"))
    rows = signal.join(sizes.select(keys[0], "n_bins"), keys[0]).select(*keys, "n_bins", F.col("value").cast("double").alias("value"), F.explode(places).alias("place"))
    last = F.floor((n - 1) / block)
    reach = F.sequence(F.greatest(F.floor((F.col("place") - radius) / block), F.lit(0).cast("long")), F.least(F.floor((F.col("place") + radius) / block), last))
    rows = rows.select(*keys, "n_bins", "value", "place", F.explode(reach).alias("block"))
    kinds = {f.name: f.dataType.simpleString() for f in signal.schema.fields}

    def convolve(key: tuple, table: pa.Table) -> pa.Table:
        start = key[-1].as_py() * block
        stop = min(start + block, table.column("n_bins")[0].as_py())
        x = np.zeros(stop - start + 2 * radius)
        x[table.column("place").to_numpy() - start + radius] = table.column("value").to_numpy()
        y = np.convolve(x, weights, "valid")
        columns = [pa.array([k.as_py()] * len(y), k.type) for k in key[:-1]]
        return pa.table([*columns, pa.array(np.arange(start, stop)), pa.array(y)], names=[*keys, "bin", "value"])

    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "bin long, value double"])
    return rows.groupBy(*keys, "block").applyInArrow(convolve, schema)
