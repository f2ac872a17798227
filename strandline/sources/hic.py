"""Binary contact files (.hic, versions 7 and 8) as contact triples: a data source that reads the footer first, then the blocks of the matrices that are asked for.

read_hic gives the columns of sources.text.TRIPLES.  A partition is a run of blocks of one matrix at one resolution, known by its place in the index of blocks; each block is a few thousand contacts.  The values of a normalisation
are counts divided by the vector's entries of both bins, which a task takes from the file (one vector a chromosome).  hic_catalog lists what files hold from their footers alone.  write_hic packs blocks in tasks
and puts each file together block by block.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from strandline.sources.files import listed, located, opened, stem
from strandline.sources.text import TRIPLES
from strandline.storage import written

#: Fixed values of the format.
MAGIC, UNIT, RAW = b"HIC\0", "BP", "NONE"
ROWS, DENSE = 1, 2
NO_COUNT = -32768
#: An entry of the index of blocks.
INDEX = np.dtype([("block", "<i4"), ("place", "<i8"), ("size", "<i4")])
#: Bytes of blocks of one partition, contacts of one batch that is read, bins of a written block to both sides.
PART_BYTES = 4 << 20
BATCH_ROWS = 1 << 16
BLOCK_BINS = 1000


class Cursor:
    """Numbers and names from a place of a file on."""

    def __init__(self, file, place: int = 0):
        self.file, self.place, self.data, self.start = file, place, b"", 0

    def _take(self, n: int) -> bytes:
        at = self.place - self.start
        if at < 0 or at + n > len(self.data):
            self.file.seek(self.place)
            self.data, self.start, at = self.file.read(max(n, 1 << 16)), self.place, 0
        self.place += n
        return self.data[at : at + n]

    def read(self, form: str) -> tuple:
        return struct.unpack("<" + form, self._take(struct.calcsize("<" + form)))

    def one(self, form: str):
        return self.read(form)[0]

    def name(self) -> str:
        out = b""
        while (c := self._take(1)) != b"\0":
            out += c
        return out.decode()

    def skip(self, n: int) -> None:
        self.place += n


class Contents:
    """Header and footer of an open file: chromosomes, resolutions, places of matrices and of normalisation vectors."""

    def __init__(self, file):
        self.file = file
        c = Cursor(file)
        if c._take(4) != MAGIC:
            raise ValueError("no .hic file")
        self.version, footer = c.one("i"), c.one("q")
        if self.version not in (7, 8):
            raise ValueError(f".hic version {self.version} is not read")
        c.name()
        for _ in range(c.one("i")):
            c.name(), c.name()
        self.chroms = [(c.name(), c.one("i")) for _ in range(c.one("i"))]
        self.resolutions = list(c.read(f"{c.one('i')}i"))
        c = Cursor(file, footer)
        c.one("i")
        self.matrices = {c.name(): c.read("qi") for _ in range(c.one("i"))}
        for normed in (False, True):  # expected values are passed over
            for _ in range(c.one("i")):
                if normed:
                    c.name()
                c.name(), c.one("i")
                c.skip(8 * c.one("i"))
                c.skip(12 * c.one("i"))
        self.vectors: dict[tuple[str, int, int], tuple[int, int]] = {}  # (norm, chromosome, resolution): place and size
        for _ in range(c.one("i")):
            norm, chrom, unit, size = c.name(), c.one("i"), c.name(), c.one("i")
            at = c.read("qi")
            if unit == UNIT:
                self.vectors[norm, chrom, size] = at

    def real(self) -> list[int]:
        """Numbers of the chromosomes but for the pseudo-chromosome of all."""
        return [k for k, (name, _) in enumerate(self.chroms) if name.lower() != "all"]

    def norms(self) -> list[str]:
        return sorted({RAW, *(n for n, _, _ in self.vectors)})

    def blocks(self, one: int, two: int, resolution: int) -> tuple[int, int]:
        """Place of the index of a matrix's blocks at a resolution, and how many there are."""
        found = (0, 0)
        if f"{one}_{two}" not in self.matrices:
            return found
        c = Cursor(self.file, self.matrices[f"{one}_{two}"][0])
        c.read("2i")
        for _ in range(c.one("i")):
            unit = c.name()
            c.read("i4f")
            size = c.one("i")
            c.read("2i")
            n = c.one("i")
            if unit == UNIT and size == resolution:
                found = (c.place, n)
            c.skip(n * INDEX.itemsize)
        return found


def index(file, place: int, n: int) -> np.ndarray:
    """n entries of an index of blocks."""
    file.seek(place)
    return np.frombuffer(file.read(n * INDEX.itemsize), INDEX)


def decode(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of both axes and counts of a block.  Entries of one cell that follow each other are the parts of its count, and are added up."""
    data = zlib.decompress(block)
    n, x0, y0, whole, kind = struct.unpack_from("<iiibb", data)
    value, at = (("<i2", 2) if whole == 0 else ("<f4", 4)), 14
    if kind == ROWS:
        xs, ys, counts = [], [], []
        (rows,) = struct.unpack_from("<h", data, at)
        at += 2
        pair = np.dtype([("x", "<i2"), ("v", value[0])])
        for _ in range(rows):
            y, m = struct.unpack_from("<hh", data, at)
            part = np.frombuffer(data, pair, m, at + 4)
            at += 4 + m * pair.itemsize
            xs.append(part["x"].astype(np.int64) + x0)
            ys.append(np.full(m, y + y0, np.int64))
            counts.append(part["v"].astype(np.float32))
        none = np.empty(0, np.int64)
        x, y, v = np.concatenate([none, *xs]), np.concatenate([none, *ys]), np.concatenate([np.empty(0, np.float32), *counts])
        again = (np.diff(x) == 0) & (np.diff(y) == 0)
        if again.any():
            first = np.flatnonzero(np.append(True, ~again))
            x, y, v = x[first], y[first], np.add.reduceat(v.astype(np.float64), first)
        return x, y, v
    if kind != DENSE:
        raise ValueError(f"unknown kind of block: {kind}")
    cells, width = struct.unpack_from("<ih", data, at)
    v = np.frombuffer(data, value[0], cells, at + 6)
    kept = np.flatnonzero(v != NO_COUNT if whole == 0 else ~np.isnan(v))
    return kept % width + x0, kept // width + y0, v[kept].astype(np.float32)


@dataclass
class Part(InputPartition):
    path: str
    norm: str
    resolution: int
    names: tuple[str, str]
    blocks: tuple[int, int]
    vectors: list[tuple[int, int] | None]


class HicReader(DataSourceReader):
    def __init__(self, path: str, norms: list[str] | None, resolution: int | None, chroms: list[str] | None, trans: bool, part_bytes: int):
        self.path, self.norms, self.resolution, self.chroms, self.trans, self.part_bytes = path, norms, resolution, chroms, trans, part_bytes

    def partitions(self) -> list[Part]:
        """Runs of blocks, from footers and the heads of the wanted matrices.  The driver looks at the index of one matrix at a time and keeps no entry of it."""
        out = []
        for path, _ in listed(self.path, (".hic",)):
            with opened(path) as file:
                c = Contents(file)
                wanted = [k for k in c.real() if self.chroms is None or c.chroms[k][0] in self.chroms]
                pairs = [(a, b) for a in wanted for b in wanted if a == b or (self.trans and a < b)]
                norms = [n for n in c.norms() if self.norms is None or n in self.norms]
                for resolution in [r for r in c.resolutions if self.resolution in (None, r)]:
                    for a, b in pairs:
                        place, n = c.blocks(a, b, resolution)
                        ends = self.ends(index(file, place, n)["size"]) if n else [0]
                        for norm in norms if n else []:
                            vectors = [c.vectors.get((norm, k, resolution)) for k in (a, b)]
                            if norm != RAW and None in vectors:
                                continue
                            for i, j in pairwise(ends):
                                out.append(Part(path, norm, resolution, (c.chroms[a][0], c.chroms[b][0]), (place + i * INDEX.itemsize, j - i), vectors if norm != RAW else []))
        return out

    def ends(self, sizes: np.ndarray) -> list[int]:
        """Where runs of part_bytes begin and end: each ends with the block that fills it."""
        upto, at = np.cumsum(sizes, dtype=np.int64), [0]
        while at[-1] < len(sizes):
            before = upto[at[-1] - 1] if at[-1] else 0
            at.append(min(int(np.searchsorted(upto, before + self.part_bytes)) + 1, len(sizes)))
        return at

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there is no block to read
            return
        names = [c.split()[0] for c in TRIPLES.split(", ")]
        p = partition
        with opened(p.path) as file:
            vectors = []
            for place, _ in p.vectors:
                c = Cursor(file, place)
                n = c.one("i")
                vectors.append(np.frombuffer(c._take(8 * n), "<f8"))
            held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

            def batch() -> pa.RecordBatch:
                x, y, v = map(np.concatenate, zip(*held))
                same = lambda value, kind: pa.repeat(pa.scalar(value, kind), len(x))
                columns = [same(stem(p.path), pa.string()), same(p.norm, pa.string()), same(p.resolution, pa.int32()), same(p.names[0], pa.string()), pa.array(x * p.resolution)]
                return pa.RecordBatch.from_arrays([*columns, same(p.names[1], pa.string()), pa.array(y * p.resolution), pa.array(v)], names=names)

            for _, place, size in index(file, *p.blocks).tolist():
                file.seek(place)
                x, y, v = decode(file.read(size))
                held.append((x, y, (v / (vectors[0][x] * vectors[1][y]) if vectors else v).astype(np.float32)))
                if sum(len(h[0]) for h in held) >= BATCH_ROWS:
                    yield batch()
                    held.clear()
            if held:
                yield batch()


class Hic(DataSource):
    """Options: path (a file or a folder), norms and chroms (by commas), resolution, trans, part_bytes."""

    @classmethod
    def name(cls) -> str:
        return "hic"

    def schema(self) -> str:
        return TRIPLES

    def reader(self, schema) -> HicReader:
        o = self.options
        many = lambda c: o[c].split(",") if c in o else None
        return HicReader(o["path"], many("norms"), int(o["resolution"]) if "resolution" in o else None, many("chroms"), o.get("trans", "true") == "true", int(o.get("part_bytes", PART_BYTES)))


def read_hic(spark: SparkSession, path: str, norms: list[str] | None = None, resolution: int | None = None, chroms: list[str] | None = None, trans: bool = True, part_bytes: int = PART_BYTES) -> DataFrame:
    """Contacts of all files of a folder, or of one (TRIPLES; bins in base pairs): of all normalisations, resolutions and chromosomes, or of the given ones; without trans only within
    chromosomes.  The earlier chromosome of the file comes first; the pseudo-chromosome "all" is left out."""
    spark.dataSource.register(Hic)
    given = {"norms": norms and ",".join(norms), "resolution": resolution, "chroms": chroms and ",".join(chroms), "trans": str(trans).lower(), "part_bytes": part_bytes}
    return spark.read.format("hic").options(**{k: v for k, v in given.items() if v is not None}).load(path)


def hic_catalog(spark: SparkSession, path: str) -> DataFrame:
    """What each file holds, as sources.text.contact_catalog gives it, from headers and footers alone: accession, resolutions, norms, chroms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at in batch.column("path").to_pylist():
                with opened(at) as file:
                    c = Contents(file)
                rows.append({"accession": stem(at), "resolutions": sorted(c.resolutions), "norms": c.norms(), "chroms": sorted(c.chroms[k][0] for k in c.real())})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("accession", pa.string()), ("resolutions", pa.list_(pa.int32())), ("norms", pa.list_(pa.string())), ("chroms", pa.list_(pa.string()))]))

    files = spark.createDataFrame([(p,) for p, _ in listed(path, (".hic",))], "path string")
    return files.repartition(F.col("path")).mapInArrow(run, "accession string, resolutions array<int>, norms array<string>, chroms array<string>")


def _put(form: str, *values) -> bytes:
    return struct.pack("<" + form, *values)


def _text(s: str) -> bytes:
    return s.encode() + b"\0"


def _head(chroms: list[tuple[str, int]], resolutions: list[int]) -> bytes:
    """What follows the magic, version and place of the footer."""
    names = _put("i", len(chroms)) + b"".join(_text(c) + _put("i", n) for c, n in chroms)
    return _text("made") + _put("i", 0) + names + _put("i", len(resolutions)) + b"".join(_put("i", r) for r in resolutions) + _put("i", 0)


def _zoom(k: int, resolution: int, block_bins: int, blocks: int) -> bytes:
    """What stands before the index of blocks of a matrix at a resolution."""
    return _text(UNIT) + _put("i4f3i", k, 0, 0, 0, 0, resolution, block_bins, 1) + _put("i", blocks)


def _footer(matrices: list[tuple[str, int, int]], vectors: list[tuple[str, int, int, int, int]]) -> bytes:
    """Places and sizes of matrices (by name) and of vectors (by norm, chromosome and resolution)."""
    expected = _text(UNIT) + _put("ii2di", 5, 2, 1.0, 2.0, 1) + _put("id", 0, 1.0)
    known = b"".join(_text(norm) + _put("i", k) + _text(UNIT) + _put("iqi", r, place, size) for norm, k, r, place, size in vectors)
    footer = _put("i", len(matrices)) + b"".join(_text(m) + _put("qi", place, size) for m, place, size in matrices) + _put("i", 1) + expected + _put("i", 1) + _text("KR") + expected + _put("i", len(vectors)) + known
    return _put("i", len(footer)) + footer


def _parts(x: np.ndarray, y: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells with counts that 32 bits hold: a whole count (of 53 bits at most) stands in up to three parts that add up to it."""
    rest, parts = v.astype(np.float64), []
    for _ in range(3):
        parts.append(rest.astype(np.float32))
        rest = np.nan_to_num(rest - parts[-1])
    each = np.stack(parts, 1)
    kept = each != 0
    kept[:, 0] = True
    times = kept.sum(1)
    return np.repeat(x, times), np.repeat(y, times), each[kept]


def pack(x: np.ndarray, y: np.ndarray, v: np.ndarray, whole: bool) -> bytes:
    """A block kept in rows, from its cells sorted by y, x.  Real counts have 32 bits; whole ones 16 where all of the block fit, else 32 and what these cannot hold in parts."""
    short = whole and bool(((v > NO_COUNT) & (v <= 32767)).all())
    if whole and not short:
        x, y, v = _parts(x, y, v)
    new = np.flatnonzero(np.diff(y, prepend=y[0] - 1))
    lengths, x0, width = np.diff(new, append=len(y)), x.min(), 2 if short else 3
    if max(lengths.max(), len(new), x.max() - x0, y[-1] - y[0]) > 32767:
        raise ValueError("bins and lengths of a block's rows have 16 bits: take fewer block_bins")
    out = np.empty(2 * len(new) + width * len(y), "<i2")
    heads = 2 * np.arange(len(new)) + width * new
    out[heads], out[heads + 1] = y[new] - y[0], lengths
    at = 2 * np.repeat(np.arange(1, len(new) + 1), lengths) + width * np.arange(len(y))
    out[at] = x - x0
    values = v.astype("<i2" if short else "<f4").view("<i2").reshape(len(v), -1)
    for k in range(width - 1):
        out[at + 1 + k] = values[:, k]
    return zlib.compress(_put("iiibbh", len(y), x0, y[0], 0 if short else 1, ROWS, len(new)) + out.tobytes())


_KEY = ["accession", "one", "two", "block_y", "block_x"]


def _packed(cells: DataFrame, block_bins: int, whole: bool) -> DataFrame:
    """Cells as blocks: accession, one, two, block_y, block_x, data.  A task holds one block and the batch that it ends in."""
    keyed = cells.withColumns({"block_x": F.floor(F.col("x") / block_bins).cast("int"), "block_y": F.floor(F.col("y") / block_bins).cast("int")})
    sorted_ = keyed.repartition(*_KEY).sortWithinPartitions(*_KEY, "y", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def blocks(rest: bool) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            code = t.column("accession").combine_chunks().dictionary_encode().indices.to_numpy()
            changed = np.zeros(max(t.num_rows - 1, 0), bool)
            for column in (code, *(t.column(c).to_numpy() for c in _KEY[1:])):
                changed |= column[1:] != column[:-1]
            ends = [0, *(np.flatnonzero(changed) + 1).tolist(), *([t.num_rows] if rest and t.num_rows else [])]
            x, y, v = (t.column(c).to_numpy() for c in ("x", "y", "counts"))
            data = [pack(x[a:b], y[a:b], v[a:b], whole) for a, b in pairwise(ends)]
            yield pa.RecordBatch.from_arrays([*(t.column(c).combine_chunks().take(pa.array(ends[:-1] if data else [], pa.int64())) for c in _KEY), pa.array(data, pa.binary())], names=[*_KEY, "data"])
            held[:] = t.slice(ends[-1]).to_batches()

        for batch in batches:
            held.append(batch)
            if batch.num_rows and sum(b.num_rows for b in held) >= BATCH_ROWS:
                yield from blocks(False)
        if held:
            yield from blocks(True)

    return sorted_.mapInArrow(run, "accession string, one int, two int, block_y int, block_x int, data binary")


def write_hic(cells: DataFrame, vectors: DataFrame, path: str, chroms: list[tuple[str, int]], resolution: int, block_bins: int = BLOCK_BINS, whole: bool = False) -> None:
    """Files of version 8 at one resolution, one for each accession, as path/accession.hic.

    cells: accession, one, x, two, y, counts (numbers of chromosomes, the lesser first, and bins), each cell once; vectors: accession, norm, chrom, values (a value for each bin).
    With whole, counts are whole numbers of any size up to 53 bits, and are kept exactly; null is a count that is not known, and is read back as NaN.
    Tasks pack blocks, squares of block_bins.  A file's blocks are then sorted to one task and written one by one: it keeps the index of one matrix, and the places of the others.  A
    file gets its name when it is whole.
    """
    blocks = written(_packed(cells.select("accession", F.col("one").cast("int"), F.col("x").cast("long"), F.col("two").cast("int"), F.col("y").cast("long"), "counts"), block_bins, whole), "hic-blocks")
    head = _head(chroms, [resolution])
    matrix = len(_put("3i", 0, 0, 0) + _zoom(0, resolution, block_bins, 0))
    # where the footer of a file begins, a row a file
    each = blocks.groupBy("accession", "one", "two").agg(F.sum(F.length("data") + INDEX.itemsize).alias("n")).groupBy("accession").agg(F.sum(F.col("n") + matrix).alias("n"))
    after = vectors.groupBy("accession").agg(F.sum(F.size("values").cast("long") * 8 + 4).alias("m"))
    starts = each.join(after, "accession", "left").select("accession", (F.col("n") + F.coalesce("m", F.lit(0)) + 16 + len(head)).alias("footer"))
    none = lambda kind: F.lit(None).cast(kind)
    shape = ["accession", "kind", "one", "two", "block_y", "block_x", "footer", "norm", "values", "data"]
    first = starts.select("accession", F.lit(0).alias("kind"), *(F.lit(-1).alias(c) for c in _KEY[1:]), "footer", none("string").alias("norm"), none("array<double>").alias("values"), none("binary").alias("data"))
    body = blocks.select("accession", F.lit(1).alias("kind"), *_KEY[1:], none("long").alias("footer"), none("string").alias("norm"), none("array<double>").alias("values"), "data")
    last = vectors.join(starts, "accession", "left_semi").select("accession", F.lit(2).alias("kind"), F.col("chrom").cast("int").alias("one"), *(F.lit(-1).alias(c) for c in _KEY[2:]), none("long").alias("footer"), "norm", "values", none("binary").alias("data"))
    rows = first.select(shape).unionByName(body.select(shape)).unionByName(last.select(shape))
    system, at = located(path)
    system.create_dir(at, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in shape}
                kind = row["kind"].as_py()
                if kind == 0:
                    if out:
                        out.close()
                    out = _Out(path, row["accession"].as_py(), head, row["footer"].as_py(), resolution, block_bins)
                elif kind == 1:
                    out.add((row["one"].as_py(), row["two"].as_py()), row["data"].as_buffer())
                else:
                    out.vector(row["norm"].as_py(), row["one"].as_py(), row["values"].values.to_numpy(zero_copy_only=False))
        if out:
            out.close()
        yield from ()

    rows.repartition("accession").sortWithinPartitions("accession", "kind", *_KEY[1:], "norm").mapInArrow(run, "done int").count()


class _Out:
    """A file that is being written, from its head to its footer."""

    def __init__(self, path: str, accession: str, head: bytes, footer: int, resolution: int, block_bins: int):
        self.system, self.at = located(f"{path}/{accession}.hic")
        _, self.made = located(f"{path}/_{accession}.hic")
        self.out, self.place, self.footer, self.resolution, self.block_bins = self.system.open_output_stream(self.made), 0, footer, resolution, block_bins
        self.pair: tuple[int, int] | None = None
        self.index: list[tuple[int, int, int]] = []
        self.matrices: list[tuple[str, int, int]] = []
        self.vectors: list[tuple[str, int, int, int, int]] = []
        self.put(MAGIC + _put("iq", 8, footer) + head)

    def put(self, data) -> tuple[int, int]:
        self.out.write(data)
        self.place += len(data)
        return self.place - len(data), len(data)

    def add(self, pair: tuple[int, int], data) -> None:
        if pair != self.pair:
            self.end()
        self.pair = pair
        self.index.append((len(self.index), *self.put(data)))

    def end(self) -> None:
        if self.pair:
            head = _put("3i", *self.pair, 1) + _zoom(0, self.resolution, self.block_bins, len(self.index))
            self.matrices.append(("%d_%d" % self.pair, *self.put(head + np.array(self.index, INDEX).tobytes())))
        self.pair, self.index = None, []

    def vector(self, norm: str, chrom: int, values: np.ndarray) -> None:
        self.end()
        self.vectors.append((norm, chrom, self.resolution, *self.put(_put("i", len(values)) + values.astype("<f8").tobytes())))

    def close(self) -> None:
        self.end()
        if self.place != self.footer:
            raise ValueError(f"{self.at}: {self.place} of {self.footer} bytes")
        self.put(_footer(self.matrices, self.vectors))
        self.out.close()
        self.system.move(self.made, self.at)


def encode(chroms: list[tuple[str, int]], contacts: dict[int, list[tuple[int, int, int, int, float]]], vectors: dict[tuple[str, int, int], list[float]], block_bins: int = 50, dense: bool = False, whole: bool = False) -> bytes:
    """A file of version 8.  contacts: by resolution (chromosome, bin, chromosome, bin, count), each cell once, the lesser chromosome first; vectors: by (norm, chromosome, resolution),
    a value for each bin.  Blocks are squares of block_bins, kept in rows or dense, with whole counts or real ones."""
    put, head = _put, _head(chroms, list(contacts))
    body, at = [], 16 + len(head)

    def packed(cells: list[tuple[int, int, float]]) -> bytes:
        x0, y0 = min(x for x, _, _ in cells), min(y for _, y, _ in cells)
        kind, value = (0, "h") if whole else (1, "f")
        out = put("iiibb", len(cells), x0, y0, kind, DENSE if dense else ROWS)
        if dense:
            width, height = max(x for x, _, _ in cells) - x0 + 1, max(y for _, y, _ in cells) - y0 + 1
            known = {(x - x0, y - y0): v for x, y, v in cells}
            out += put("ih", width * height, width) + b"".join(put(value, known.get((k % width, k // width), NO_COUNT if whole else float("nan"))) for k in range(width * height))
        else:
            rows: dict[int, list] = {}
            for x, y, v in cells:
                rows.setdefault(y - y0, []).append((x - x0, v))
            out += put("h", len(rows)) + b"".join(put("hh", y, len(r)) + b"".join(put("h" + value, x, v) for x, v in r) for y, r in rows.items())
        return zlib.compress(out)

    matrices: dict[tuple[int, int], list[tuple[int, list]]] = {}
    for resolution, cells in contacts.items():
        by: dict[tuple[int, int], dict] = {}
        for a, x, b, y, v in cells:
            by.setdefault((a, b), {}).setdefault((x // block_bins, y // block_bins), []).append((x, y, int(v) if whole else v))
        for pair, blocks in by.items():
            places = []
            for k, each in enumerate(blocks.values()):
                data = packed(each)
                places.append((k, at, len(data)))
                body.append(data)
                at += len(data)
            matrices.setdefault(pair, []).append((resolution, places))
    entries = []
    for (a, b), zooms in matrices.items():
        data = put("3i", a, b, len(zooms))
        for k, (resolution, places) in enumerate(zooms):
            data += _zoom(k, resolution, block_bins, len(places)) + b"".join(put("iqi", *p) for p in places)
        entries.append((f"{a}_{b}", at, len(data)))
        body.append(data)
        at += len(data)
    known = []
    for (norm, chrom, resolution), values in vectors.items():
        data = put("i", len(values)) + put(f"{len(values)}d", *values)
        known.append((norm, chrom, resolution, at, len(data)))
        body.append(data)
        at += len(data)
    return MAGIC + put("iq", 8, at) + head + b"".join(body) + _footer(entries, known)
