"""Binary signal files (bigWig) as ranges: a data source that reads the chromosome tree and the interval index first, then only the blocks that are asked for.

read_bigwig gives file, accession (the file's name), chrom, start, end, value.  A partition is a run of data blocks; for a wanted range the index leaves out blocks, so a question
about one reads some kilobytes of a large file.  The range is an option of the reader: filters that Spark 4.1 pushes into a Python source stay with it for later
scans of the same DataFrame (seen: a count without a filter gives the rows of the filter before), so this source takes none.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from strandline.sources.files import listed, opened, stem

#: Fixed values of the format: first numbers of a file, of the chromosome tree and of the interval index.
MAGIC, TREE_MAGIC, INDEX_MAGIC = 0x888FFC26, 0x78CA8C91, 0x2468ACE0
RANGES, STEPS, FIXED = 1, 2, 3
SCHEMA = "file string, accession string, chrom string, start long, end long, value float"
#: Bytes of data blocks of one partition.
PART_BYTES = 8 << 20
#: Ranges of a block, and children of a node, as encode() writes them.
SLOT, FAN = 512, 64


class Index:
    """Chromosomes, and the data blocks with the ranges that they hold, of an open file."""

    def __init__(self, file, keep=lambda chrom, start, end: True):
        self.file, self.keep = file, keep
        head = self._at(0, 64)
        self.order = "<" if struct.unpack("<I", head[:4])[0] == MAGIC else ">"
        if self._read("I", head)[0] != MAGIC:
            raise ValueError("no bigWig file")
        _, _, _, tree, _, index, _, _, _, _, self.unpacked, _ = self._read("IHHQQQHHQQIQ", head)
        self.names: dict[int, str] = {}
        magic, _, key, _, _, _ = self._read("IIIIQQ", self._at(tree, 32))
        if magic != TREE_MAGIC:
            raise ValueError("no chromosome tree")
        self._chromosomes(tree + 32, key)
        if self._read("I", self._at(index, 48))[0] != INDEX_MAGIC:
            raise ValueError("no interval index")
        self.blocks: list[tuple[int, int]] = []  # place and size
        self._nodes(index + 48)

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def _read(self, form: str, data: bytes, place: int = 0) -> tuple:
        return struct.unpack_from(self.order + form, data, place)

    def _chromosomes(self, place: int, key: int) -> None:
        leaf, _, count = self._read("BBH", self._at(place, 4))
        data = self._at(place + 4, count * (key + 8))
        for k in range(count):
            at = k * (key + 8)
            if leaf:
                self.names[self._read("I", data, at + key)[0]] = data[at : at + key].rstrip(b"\0").decode()
            else:
                self._chromosomes(self._read("Q", data, at + key)[0], key)

    def _nodes(self, place: int) -> None:
        leaf, _, count = self._read("BBH", self._at(place, 4))
        size = 32 if leaf else 24
        data = self._at(place + 4, count * size)
        for k in range(count):
            c1, start, c2, end, at = self._read("IIIIQ", data, k * size)
            if any(self.keep(self.names[c], start if c == c1 else 0, end if c == c2 else 1 << 40) for c in range(c1, c2 + 1) if c in self.names):
                if leaf:
                    self.blocks.append((at, self._read("Q", data, k * size + 24)[0]))
                else:
                    self._nodes(at)


def decode(block: bytes, packed: bool, order: str = "<") -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Number of the chromosome, starts, ends and values of a data block."""
    data = zlib.decompress(block) if packed else block
    chrom, start, _, step, span, kind, _, count = struct.unpack_from(order + "IIIIIBBH", data)
    body = data[24:]
    u, f = order + "u4", order + "f4"
    if kind == RANGES:
        rows = np.frombuffer(body, np.dtype([("a", u), ("b", u), ("v", f)]), count)
        return chrom, rows["a"].astype(np.int64), rows["b"].astype(np.int64), rows["v"].astype(np.float32)
    if kind == STEPS:
        rows = np.frombuffer(body, np.dtype([("a", u), ("v", f)]), count)
        return chrom, rows["a"].astype(np.int64), rows["a"].astype(np.int64) + span, rows["v"].astype(np.float32)
    if kind != FIXED:
        raise ValueError(f"unknown kind of block: {kind}")
    first = start + step * np.arange(count, dtype=np.int64)
    return chrom, first, first + span, np.frombuffer(body, f, count).astype(np.float32)


@dataclass
class Blocks(InputPartition):
    path: str
    names: dict[int, str]
    blocks: list[tuple[int, int]]
    packed: bool
    order: str


class BigWigReader(DataSourceReader):
    def __init__(self, path: str, part_bytes: int, chrom: str | None, low: int, high: int):
        self.path, self.part_bytes, self.chrom, self.low, self.high = path, part_bytes, chrom, low, high

    def _wanted(self, chrom: str, start: int, end: int) -> bool:
        return (self.chrom is None or chrom == self.chrom) and end > self.low and start < self.high

    def partitions(self) -> list[Blocks]:
        """Runs of blocks of some megabytes, from the indexes of all files (32 bytes for each of their blocks)."""
        out = []
        for path, _ in listed(self.path, (".bw", ".bigWig", ".bigwig")):
            with opened(path) as file:
                index = Index(file, self._wanted)
            run, total = [], 0
            for block in index.blocks:
                run.append(block)
                total += block[1]
                if total >= self.part_bytes:
                    out.append(Blocks(path, index.names, run, index.unpacked > 0, index.order))
                    run, total = [], 0
            if run:
                out.append(Blocks(path, index.names, run, index.unpacked > 0, index.order))
        return out

    def read(self, partition: Blocks | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there is no block to read
            return
        names = ["file", "accession", "chrom", "start", "end", "value"]
        with opened(partition.path) as file:
            for place, size in partition.blocks:
                file.seek(place)
                chrom, start, end, value = decode(file.read(size), partition.packed, partition.order)
                n = len(start)
                same = [pa.array([x] * n, pa.string()) for x in (partition.path, stem(partition.path), partition.names[chrom])]
                yield pa.RecordBatch.from_arrays([*same, pa.array(start), pa.array(end), pa.array(value)], names=names)


class BigWig(DataSource):
    """Options: path (a file or a folder), part_bytes, chrom, start, end."""

    @classmethod
    def name(cls) -> str:
        return "bigwig"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BigWigReader:
        o = self.options
        return BigWigReader(o["path"], int(o.get("part_bytes", PART_BYTES)), o.get("chrom"), int(o.get("start", 0)), int(o.get("end", 1 << 40)))


def read_bigwig(spark: SparkSession, path: str, chrom: str | None = None, start: int | None = None, end: int | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """Ranges of all files of a folder, or of one: file, accession, chrom, start, end, value; of one chromosome, or of those that overlap start to end, if given."""
    spark.dataSource.register(BigWig)
    wanted = {k: v for k, v in {"chrom": chrom, "start": start, "end": end}.items() if v is not None}
    rows = spark.read.format("bigwig").option("part_bytes", part_bytes).options(**wanted).load(path)
    if chrom is not None:
        rows = rows.where(F.col("chrom") == chrom)
    if start is not None:
        rows = rows.where(F.col("end") > start)
    return rows if end is None else rows.where(F.col("start") < end)


def encode(sizes: list[tuple[str, int]], ranges: list[tuple[str, int, int, float]], packed: bool = True, kind: int = RANGES, order: str = "<") -> bytes:
    """A file of ranges (chrom, start, end, value; in order of chromosomes, then starts, not overlapping).  Kinds STEPS and FIXED need ranges of one length (at one distance)."""
    ids = {c: k for k, (c, _) in enumerate(sizes)}
    put = lambda form, *v: struct.pack(order + form, *v)
    width = max([len(c) for c, _ in sizes] + [1])
    tree = put("IIIIQQ", TREE_MAGIC, max(len(sizes), 1), width, 8, len(sizes), 0) + put("BBH", 1, 0, len(sizes))
    tree += b"".join(c.encode().ljust(width, b"\0") + put("II", ids[c], n) for c, n in sizes)
    data_at = 64 + len(tree)
    body, entries, at = [], [], data_at + 4
    groups: list[list] = []
    for r in ranges:
        if not groups or groups[-1][0][0] != r[0] or len(groups[-1]) == SLOT:
            groups.append([])
        groups[-1].append(r)
    largest = 0
    for group in groups:
        step = group[1][1] - group[0][1] if kind == FIXED and len(group) > 1 else 0
        head = put("IIIIIBBH", ids[group[0][0]], group[0][1], group[-1][2], step, 0 if kind == RANGES else group[0][2] - group[0][1], kind, 0, len(group))
        rows = b"".join(put("IIf", a, b, v) if kind == RANGES else put("If", a, v) if kind == STEPS else put("f", v) for _, a, b, v in group)
        largest = max(largest, len(head + rows))
        block = zlib.compress(head + rows) if packed else head + rows
        entries.append((ids[group[0][0]], group[0][1], ids[group[0][0]], group[-1][2], at, len(block)))
        body.append(block)
        at += len(block)
    # the index from the leaves up; nodes are placed once all levels are known
    levels, nodes = [], [(e[:4], e) for e in entries]
    while True:
        level = [nodes[k : k + FAN] for k in range(0, len(nodes), FAN)] or [[]]
        levels.append(level)
        if len(level) == 1:
            break
        nodes = [((g[0][0][0], g[0][0][1], g[-1][0][2], max(x[0][3] for x in g)), None) for g in level]
    index_at, place, places = at, at + 48, []
    for depth, level in enumerate(reversed(levels)):
        size = 32 if depth == len(levels) - 1 else 24
        places.append([])
        for node in level:
            places[-1].append(place)
            place += 4 + size * len(node)
    index = b""
    for depth, level in enumerate(reversed(levels)):
        leaf, child = depth == len(levels) - 1, 0
        for node in level:
            index += put("BBH", int(leaf), 0, len(node))
            for box, entry in node:
                index += put("IIII", *box) + (put("QQ", entry[4], entry[5]) if leaf else put("Q", places[depth + 1][child]))
                child += 1
    ends = (entries[0][0], entries[0][1], entries[-1][2], entries[-1][3]) if entries else (0, 0, 0, 0)
    index = put("IIQIIIIQII", INDEX_MAGIC, FAN, len(entries), *ends, at, SLOT, 0) + index
    head = put("IHHQQQHHQQIQ", MAGIC, 4, 0, 64, data_at, index_at, 0, 0, 0, 0, largest if packed else 0, 0)
    return head + tree + put("I", len(groups)) + b"".join(body) + index
