"""Array files (.npz) as blocks of a signal or rows of a contact matrix, and the same tables in Parquet."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 1 << 16
SIGNAL = "file string, chrom string, chrom_size long, resolution int, track_idx int, block_idx long, values array<float>"
CONTACTS = "file string, chrom string, start long, end long, resolution int, track_idx int, track_name string, row_idx long, row array<float>"


def read_signal(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """1-D track files as blocks of ``block`` bins."""
    return decode_signal(spark.read.format("binaryFile").load(path), block)


def decode_signal(files: DataFrame, block: int = BLOCK) -> DataFrame:
    """1-D track files (path, content; in it values: bins x tracks, resolution, chrom, chrom_size) as blocks of ``block`` bins.  A task holds one
    file, as the format cannot be cut; write_signal keeps the blocks, which can."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                data = np.load(io.BytesIO(content.as_buffer()), allow_pickle=False)
                values = data["values"]
                values = values[:, None] if values.ndim == 1 else values
                for t in range(values.shape[1]):
                    for k in range(0, len(values), block):
                        row = [[file], [str(data["chrom"])], [int(data["chrom_size"])], [int(data["resolution"])], [t], [k // block], [values[k : k + block, t]]]
                        types = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float32())]
                        yield pa.RecordBatch.from_arrays([pa.array(v, t_) for v, t_ in zip(row, types)], names=["file", "chrom", "chrom_size", "resolution", "track_idx", "block_idx", "values"])

    return files.select("path", "content").mapInArrow(run, SIGNAL)


def read_contacts(spark: SparkSession, path: str) -> DataFrame:
    """Contact window files as matrix rows."""
    return decode_contacts(spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path))


def decode_contacts(files: DataFrame) -> DataFrame:
    """Contact window files (path {chrom}_{start}_{end}.npz, content; in it values: bins x bins x tracks) as matrix rows; other names are left out.

    A file without tracks, or with values of another shape, gives no rows (see window_files); tracks without names are called contact_track_0 and so on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content, chrom, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "content", "chrom", "start", "end"))):
                data = np.load(io.BytesIO(content), allow_pickle=False)
                values = data["values"]
                if values.ndim != 3:
                    continue
                n, n_tracks = len(values), values.shape[2]
                names = [str(x) for x in data["track_names"]] if "track_names" in data else [f"contact_track_{t}" for t in range(n_tracks)]
                for t, name in enumerate(names):
                    columns = [[file] * n, [chrom] * n, [start] * n, [end] * n, [int(data["resolution"])] * n, [t] * n, [name] * n, list(range(n)), list(values[:, :, t])]
                    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.list_(pa.float32())]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t_) for v, t_ in zip(columns, types)], names=["file", "chrom", "start", "end", "resolution", "track_idx", "track_name", "row_idx", "row"])

    return window_files(files).mapInArrow(run, CONTACTS)


def window_files(files: DataFrame) -> DataFrame:
    """Files named like contact windows: their columns, and chrom, start, end from the name.  Where only these are selected, no content is read."""
    name = F.regexp_extract("path", r"([^/]+)\.npz$", 1)
    part = lambda k: F.regexp_extract(name, r"^(.+)_(\d+)_(\d+)$", k)
    return files.where(part(1) != "").withColumns({"chrom": part(1), "start": part(2).cast("long"), "end": part(3).cast("long")})


def read_track_names(spark: SparkSession, path: str) -> DataFrame:
    """Sidecar lists of track descriptions."""
    return parse_track_names(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value"))


def parse_track_names(texts: DataFrame) -> DataFrame:
    """From (file, value): file, track_idx, name, strand, transcription_factor, extra (the whole object as JSON); the place in the list is the track."""
    raw = texts.select("file", F.posexplode(F.from_json("value", "array<string>")).alias("track_idx", "extra"))
    field = lambda k: F.get_json_object("extra", f"$.{k}").alias(k)
    return raw.select("file", "track_idx", field("name"), field("strand"), field("transcription_factor"), "extra")


def long_form(blocks: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row a bin: chrom, track_idx, bin, value."""
    return blocks.select("chrom", "track_idx", "block_idx", F.posexplode("values").alias("i", "value")).select("chrom", "track_idx", (F.col("block_idx") * block + F.col("i")).alias("bin"), "value")


def to_blocks(signal: DataFrame, block: int = BLOCK) -> DataFrame:
    """A dense long signal (chrom, track_idx, bin, value) as blocks."""
    rows = signal.groupBy("chrom", "track_idx", F.floor(F.col("bin") / block).alias("block_idx")).agg(F.array_sort(F.collect_list(F.struct("bin", "value"))).alias("v"))
    return rows.select("chrom", "track_idx", "block_idx", F.transform("v", lambda s: s["value"]).alias("values"))


def write_signal(signal: DataFrame, path: str, block: int = BLOCK) -> None:
    """A dense long signal (assay, chrom, track_idx, bin, value) as blocks, by assay and chromosome; of the partitions only those present are replaced."""
    rows = signal.groupBy("assay", "chrom", "track_idx", F.floor(F.col("bin") / block).alias("block_idx")).agg(F.array_sort(F.collect_list(F.struct("bin", "value"))).alias("v"))
    blocks = rows.select("assay", "chrom", "track_idx", "block_idx", F.transform("v", lambda s: s["value"].cast("float")).alias("values"))
    blocks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("assay", "chrom").parquet(path)


def write_contacts(rows: DataFrame, path: str) -> None:
    """Matrix rows (chrom, start, end, resolution, track_name, row_idx, row) by chromosome; an error where there are none."""
    if rows.isEmpty():
        raise ValueError("no contact maps in the output")
    kept = rows.select("chrom", "start", "end", "resolution", "track_name", "row_idx", F.col("row").cast("array<float>").alias("row"))
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chrom").parquet(path)
