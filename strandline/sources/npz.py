"""Array files (.npz) as data sources: readers that deal row ranges of a file to tasks, and a writer that commits in two phases.

A file is a zip folder of arrays.  The reader's planner takes its directory and the head of ``values``; where that is stored plainly, ranges of its rows are partitions and a task
reads only its own; a compressed one is one partition, read as a stream.  No task holds more than some rows.
"""

from __future__ import annotations

import io
import json
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from numpy.lib import format as npy
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from strandline.sources.arrays import BLOCK, CONTACTS, SIGNAL
from strandline.sources.files import listed, located, opened

#: Bytes of values of one partition.
PART_BYTES = 16 << 20
#: What the writer takes, sorted by file, block_idx, track_idx.
TRACKS = "file string, chrom string, chrom_size long, resolution int, n_tracks int, n_bins long, block_idx long, track_idx int, values array<float>"


@dataclass
class Rows(InputPartition):
    path: str
    info: dict[str, Any]
    shape: tuple[int, ...]
    dtype: str
    place: int | None  # of the first row in the file; None: compressed
    first: int
    last: int


def _head(stream) -> tuple[tuple[int, ...], bool, np.dtype]:
    version = npy.read_magic(stream)
    return npy.read_array_header_1_0(stream) if version == (1, 0) else npy.read_array_header_2_0(stream)


def members(path: str) -> tuple[dict[str, Any], tuple[int, ...], np.dtype, int | None]:
    """The small arrays of a file, and shape, type and place of ``values`` (the first row's; None where it is compressed)."""
    with opened(path) as file, zipfile.ZipFile(file) as folder:
        small = {}
        for entry in folder.infolist():
            name = entry.filename.removesuffix(".npy")
            if name != "values":
                small[name] = np.load(io.BytesIO(folder.read(entry)), allow_pickle=False).tolist()
        entry = folder.getinfo("values.npy")
        with folder.open(entry) as stream:
            shape, columns, dtype = _head(stream)
            if columns and len(shape) > 1 and min(shape) > 1:
                raise ValueError(f"{path}: values in the order of columns")
            head = stream.tell()
        if entry.compress_type != zipfile.ZIP_STORED:
            return small, shape, dtype, None
        file.seek(entry.header_offset + 26)
        name, extra = np.frombuffer(file.read(4), "<u2").astype(int).tolist()
        return small, shape, dtype, entry.header_offset + 30 + name + extra + head


class RowReader(DataSourceReader):
    """Row ranges of ``values`` in all files of a folder."""

    def __init__(self, path: str, part_bytes: int, block: int):
        self.path, self.part_bytes, self.block = path, part_bytes, block

    def wanted(self, path: str) -> bool:
        return True

    def partitions(self) -> list[Rows]:
        out = []
        for path, _ in listed(self.path, (".npz",)):
            if not self.wanted(path):
                continue
            info, shape, dtype, place = members(path)
            width = max(1, int(np.prod(shape[1:], dtype=np.int64))) * dtype.itemsize
            step = max(1, self.part_bytes // (width * self.block)) * self.block if place is not None else max(shape[0], 1)
            out += [Rows(path, info, shape, dtype.str, place, a, min(a + step, shape[0])) for a in range(0, shape[0], step)]
        return out

    def pieces(self, part: Rows | None) -> Iterator[tuple[int, np.ndarray]]:
        """The rows of a partition, ``block`` at a time, with the number of the first."""
        if part is None:
            return
        width = int(np.prod(part.shape[1:], dtype=np.int64)) * np.dtype(part.dtype).itemsize
        if not width:  # no track
            return
        with opened(part.path) as file, zipfile.ZipFile(file) as folder:
            stream = file if part.place is not None else folder.open("values.npy")
            if part.place is not None:
                file.seek(part.place + part.first * width)
            else:
                _head(stream)
            for a in range(part.first, part.last, self.block):
                n = min(self.block, part.last - a)
                data = stream.read(n * width)
                yield a, np.frombuffer(data, part.dtype).reshape(n, *part.shape[1:])


def _text(v: Any) -> str:
    return str(v)


class TrackReader(RowReader):
    def read(self, partition: Rows | None) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SIGNAL.split(", ")]
        for a, x in self.pieces(partition):
            x = x.reshape(len(x), -1)
            info, n = partition.info, x.shape[1]
            flat = pa.array(np.ascontiguousarray(x.T).ravel().astype(np.float32))
            values = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(x)), flat)
            same = [pa.array([partition.path] * n), pa.array([_text(info["chrom"])] * n), pa.array([int(info["chrom_size"])] * n), pa.array([int(info["resolution"])] * n, pa.int32())]
            yield pa.RecordBatch.from_arrays([*same, pa.array(range(n), pa.int32()), pa.array([a // self.block] * n), values], names=names)


_WINDOW = re.compile(r"^(.+)_(\d+)_(\d+)\.npz$")


class ContactReader(RowReader):
    def wanted(self, path: str) -> bool:
        return _WINDOW.match(path.rsplit("/", 1)[-1]) is not None

    def partitions(self) -> list[Rows]:
        return [p for p in super().partitions() if len(p.shape) == 3 and p.shape[2]]

    def read(self, partition: Rows | None) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in CONTACTS.split(", ")]
        for a, x in self.pieces(partition):
            n, bins, tracks = x.shape
            chrom, start, end = _WINDOW.match(partition.path.rsplit("/", 1)[-1]).groups()
            called = partition.info.get("track_names", [f"contact_track_{t}" for t in range(tracks)])
            for t in range(tracks):
                rows = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bins), pa.array(np.ascontiguousarray(x[:, :, t]).ravel().astype(np.float32)))
                same = [[partition.path] * n, [chrom] * n, [int(start)] * n, [int(end)] * n, [int(partition.info["resolution"])] * n, [t] * n, [str(called[t])] * n, list(range(a, a + n))]
                types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([*(pa.array(v, k) for v, k in zip(same, types)), rows], names=names)


class TrackWriter(DataSourceArrowWriter):
    """Each task writes its files into a folder of the job; at the end of the job they are moved to their places, or all go."""

    def __init__(self, path: str):
        self.path, self.folder = path.rstrip("/"), f"{path.rstrip('/')}/_temporary/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        mine = f"{self.folder}/{uuid.uuid4().hex}"
        done: list[tuple[str, str]] = []
        state = None
        for batch in iterator:
            for row in batch.to_pylist():
                if state is None or row["file"] != state.file:
                    if state is not None:
                        done.append(state.close())
                    state = _Open(row, f"{mine}/{len(done)}.npz", f"{self.path}/{row['file']}.npz")
                state.add(row)
        if state is not None:
            done.append(state.close())
        return Written(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        for m in messages:
            for source, target in m.files if m else []:
                system, at = located(source)
                _, to = located(target)
                system.create_dir(to.rsplit("/", 1)[0], recursive=True)
                system.move(at, to)
        self._clear()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        system, at = located(self.folder)
        for folder in (at, at.rsplit("/", 1)[0]):
            if system.get_file_info(folder).type.name == "Directory" and (folder == at or not system.get_file_info(_children(folder))):
                system.delete_dir(folder)


def _children(folder: str):
    from pyarrow.fs import FileSelector

    return FileSelector(folder)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class _Open:
    """A file that is being written: one block of all tracks at a time."""

    def __init__(self, row: dict, path: str, target: str):
        self.file, self.path, self.target, self.n, self.bins = row["file"], path, target, row["n_tracks"], row["n_bins"]
        system, at = located(path)
        system.create_dir(at.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(at)
        self.folder = zipfile.ZipFile(_Forward(self.out), "w", zipfile.ZIP_STORED)
        for name, value in (("resolution", np.int32(row["resolution"])), ("chrom", np.array(row["chrom"])), ("chrom_size", np.int64(row["chrom_size"]))):
            data = io.BytesIO()
            np.save(data, value, allow_pickle=False)
            self.folder.writestr(f"{name}.npy", data.getvalue())
        self.values = self.folder.open(zipfile.ZipInfo("values.npy"), "w", force_zip64=True)
        head = io.BytesIO()
        npy.write_array_header_1_0(head, {"descr": "<f4", "fortran_order": False, "shape": (self.bins, self.n)})
        self.values.write(head.getvalue())
        self.block: list[np.ndarray] = []
        self.written = 0

    def add(self, row: dict) -> None:
        if row["track_idx"] != len(self.block):
            raise ValueError(f"{self.file}: track {len(self.block)} has no block {row['block_idx']}")
        self.block.append(np.asarray(row["values"], np.float32))
        if len(self.block) == self.n:
            self.values.write(np.column_stack(self.block).astype("<f4").tobytes())
            self.written += len(self.block[0])
            self.block = []

    def close(self) -> tuple[str, str]:
        if self.block or self.written != self.bins:
            raise ValueError(f"{self.file}: {self.written} of {self.bins} bins")
        self.values.close()
        self.folder.close()
        self.out.close()
        return self.path, self.target


class _Forward(io.RawIOBase):
    """An output stream for zipfile, which then never goes back."""

    def __init__(self, out):
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.out.write(bytes(data))
        return len(data)

    def flush(self) -> None:
        pass


class Tracks(DataSource):
    """1-D track files; options: path, part_bytes, block."""

    @classmethod
    def name(cls) -> str:
        return "npz_tracks"

    def schema(self) -> str:
        return SIGNAL

    def reader(self, schema) -> TrackReader:
        return TrackReader(self.options["path"], int(self.options.get("part_bytes", PART_BYTES)), int(self.options.get("block", BLOCK)))

    def writer(self, schema, overwrite: bool) -> TrackWriter:
        return TrackWriter(self.options["path"])


class Contacts(DataSource):
    """Contact window files; options: path, part_bytes, block (rows read at once)."""

    @classmethod
    def name(cls) -> str:
        return "npz_contacts"

    def schema(self) -> str:
        return CONTACTS

    def reader(self, schema) -> ContactReader:
        return ContactReader(self.options["path"], int(self.options.get("part_bytes", PART_BYTES)), int(self.options.get("block", 256)))


def read_tracks(spark: SparkSession, path: str, block: int = BLOCK, part_bytes: int = PART_BYTES) -> DataFrame:
    """Track files as blocks of ``block`` bins (sources.arrays.SIGNAL).  A file of 1-D values has one track, one of 0 tracks gives no rows."""
    spark.dataSource.register(Tracks)
    return spark.read.format("npz_tracks").option("block", block).option("part_bytes", part_bytes).load(path)


def read_contacts(spark: SparkSession, path: str, part_bytes: int = PART_BYTES, block: int = 256) -> DataFrame:
    """Contact window files as matrix rows (sources.arrays.CONTACTS); files of 0 tracks, other shapes or other names give no rows, unnamed tracks are contact_track_0 and so on."""
    spark.dataSource.register(Contacts)
    return spark.read.format("npz_contacts").option("part_bytes", part_bytes).option("block", block).load(path)


def write_tracks(blocks: DataFrame, path: str) -> None:
    """Blocks of tracks (assay, chrom, chrom_size, resolution, track_idx, block_idx, values) as path/assay/chrom.npz, that can be read in ranges.

    A file's blocks are sorted to one task and written one by one, so a task holds a block of all tracks.  Files appear at the end of the job, all of them or none; existing ones are
    replaced.  An error where a track lacks a block, or bins.
    """
    spark = blocks.sparkSession
    spark.dataSource.register(Tracks)
    bins = F.ceil(F.col("chrom_size") / F.col("resolution")).alias("n_bins")
    counts = blocks.groupBy("assay", "chrom").agg((F.max("track_idx") + 1).cast("int").alias("n_tracks"))  # a row a file
    rows = blocks.join(counts, ["assay", "chrom"])
    rows = rows.select(
        F.concat_ws("/", "assay", "chrom").alias("file"), "chrom", F.col("chrom_size").cast("long").alias("chrom_size"), F.col("resolution").cast("int").alias("resolution"), "n_tracks", bins,
        F.col("block_idx").cast("long").alias("block_idx"), F.col("track_idx").cast("int").alias("track_idx"), F.col("values").cast("array<float>").alias("values"),
    )
    sorted_ = rows.repartition("file").sortWithinPartitions("file", "block_idx", "track_idx")
    sorted_.write.format("npz_tracks").mode("append").save(path)


def write_track_names(names: DataFrame, path: str) -> None:
    """Descriptions of tracks (assay, chrom, track_idx, name, others) as path/assay/chrom.json beside the arrays: some hundreds for each file; NaN and infinities are null."""
    others = [c for c in names.columns if c not in ("assay", "chrom", "track_idx")]
    listed_ = names.groupBy("assay", "chrom").agg(F.array_sort(F.collect_list(F.struct("track_idx", F.struct(*others).alias("x")))).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, at = located(f"{path}/{row['assay']}/{row['chrom']}.json")
                system.create_dir(at.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(at) as out:
                    safe = [{k: None if isinstance(v, float) and not np.isfinite(v) else v for k, v in x["x"].items()} for x in row["v"]]
                    out.write(json.dumps(safe).encode())
                yield pa.RecordBatch.from_arrays([pa.array([at])], names=["at"])

    listed_.mapInArrow(run, "at string").count()
