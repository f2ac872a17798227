"""Token ids of a corpus in a binary format with random access: directly addressable codes.

A segment holds the ids of consecutive documents.  Each id is cut into chunks of 8 bits, lowest first.  Level k holds the
k-th chunk of every id that has one, and a bitmap that says which of them go on to level k + 1.  A rank directory counts the
set bits before every 512-bit block, so the place of an id in the next level is found by one look-up and one popcount of a
block: any id can be read alone, without decoding others.

Segment layout (little-endian): magic "DAC1", u32 levels, u64 ids; then for each level u64 entries, entries bytes of chunks,
and, but for the last level, u64 words of the bitmap (64 bits each) and one u32 rank for each 512-bit block.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import slices
from strandline.storage import new_path

END_ID = 2
BLOCK = 512
#: Ids of one segment, about; a longer document still has one segment to itself.
SEGMENT_IDS = 1 << 19
#: Text pieces whose ids a Python worker remembers, over all its tasks; beyond, it forgets them all and goes on.
CACHE = 1_200_000

# Pieces that can be encoded apart, since no token crosses their ends whatever stands beside them: a run of letters with the
# space before it; the signs after such a run, up to white space; a single other white space; else a run of white space with all that
# follows up to the next.  The white space is what the tokenizer's own pattern knows, the letters those of ASCII and Latin-1.
_SPACE = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_SIGNS = r"!-/:-@\[-`{-~"
_PIECE = re.compile(
    f"[{_SPACE}]{{2,}}[^{_SPACE}]*| ?[{_LETTERS}]+(?=[{_SIGNS}]*(?:[{_SPACE}]|\\Z))|[{_SIGNS}]+(?=[{_SPACE}]|\\Z)|[\t\n\r](?=[^{_SPACE}])|[{_SPACE}]?[^{_SPACE}]+|[{_SPACE}]"
)
#: Pieces that the tokenizer's pattern leaves whole, so that its model alone can encode them.
_WHOLE = re.compile(f" ?[{_LETTERS}]+|[{_SIGNS}]+")
# The byte-level alphabet: visible characters of Latin-1 stand for themselves, the other bytes, in order, for 256, 257, ...
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _VISIBLE]
_ALPHABET = [chr(b) if b in _VISIBLE else chr(256 + _HIDDEN.index(b)) for b in range(256)]
_BLANK = _ALPHABET[32]
_BITS = np.array([bin(x).count("1") for x in range(256)], np.uint16)


def dac_encode(ids: np.ndarray) -> bytes:
    """ids (unsigned 32-bit) as a segment."""
    levels, x = [], np.asarray(ids, np.uint32)
    while True:
        more = x >= 256
        levels.append(((x & 255).astype(np.uint8), more))
        if not more.any():
            break
        x = x[more] >> 8
    out = [b"DAC1", struct.pack("<IQ", len(levels), len(ids))]
    for k, (chunks, more) in enumerate(levels):
        out += [struct.pack("<Q", len(chunks)), chunks.tobytes()]
        if k < len(levels) - 1:
            bits = np.packbits(more, bitorder="little")
            bits = np.concatenate((bits, np.zeros(-len(bits) % (BLOCK // 8), np.uint8)))
            per_block = _BITS[bits].reshape(-1, BLOCK // 8).sum(1, dtype=np.uint64)
            ranks = np.concatenate(([0], np.cumsum(per_block)[:-1])).astype(np.uint32)
            out += [struct.pack("<Q", len(bits) // 8), bits.tobytes(), ranks.tobytes()]
    return b"".join(out)


class Dac:
    """Reader of a segment."""

    def __init__(self, data: bytes):
        assert data[:4] == b"DAC1", "not a segment"
        n_levels, self.n = struct.unpack_from("<IQ", data, 4)
        at, self.levels = 16, []
        for k in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            at += 8 + n
            bits = ranks = None
            if k < n_levels - 1:
                (words,) = struct.unpack_from("<Q", data, at)
                bits = np.frombuffer(data, np.uint8, words * 8, at + 8)
                at += 8 + words * 8
                ranks = np.frombuffer(data, np.uint32, words * 64 // BLOCK, at)
                at += 4 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def __getitem__(self, i: int) -> int:
        """The i-th id, read alone."""
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if bits is None or not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            whole = bits[block * BLOCK // 8 : i >> 3]
            i = int(ranks[block]) + int(_BITS[whole].sum()) + int(_BITS[bits[i >> 3] & ((1 << (i & 7)) - 1)])
            shift += 8
        return value

    def ids(self) -> np.ndarray:
        """All ids."""
        out = None
        for chunks, bits, _ in reversed(self.levels):
            x = chunks.astype(np.uint32)
            if bits is not None:
                x[np.unpackbits(bits, count=len(chunks), bitorder="little").view(bool)] |= out << np.uint32(8)
            out = x
        return out


def fits(description: dict) -> bool:
    """Whether a tokenizer cuts texts as the pieces above assume: byte-level with its own pattern, and nothing changed before."""
    cut = description.get("pre_tokenizer") or {}
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
    return plain and not description.get("normalizer") and description["model"]["type"] == "BPE" and not description["model"].get("dropout")


class PieceEncoder:
    """Ids of texts, piece by piece; pieces met before come from a bounded memory.  With a tokenizer that these pieces don't fit, whole texts are encoded."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.fits = fits(json.loads(self.tokenizer.to_str()))
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 20, np.uint32)
        self.starts, self.used = np.zeros(1 << 16, np.int64), 0

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces: by the model alone where they are whole, else as small texts."""
        flat, counts, model = [], [], self.tokenizer.model
        whole, other = [], []
        for p in pieces:
            (whole if _WHOLE.fullmatch(p) else other).append(p)
        for p in whole:
            found = model.tokenize(p.replace(" ", _BLANK) if p.isascii() else "".join([_ALPHABET[b] for b in p.encode()]))
            flat += [t.id for t in found]
            counts.append(len(found))
        for code in self.tokenizer.encode_batch_fast(other, add_special_tokens=False) if other else []:
            flat += code.ids
            counts.append(len(code.ids))
        n = len(self.known)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while n + len(pieces) + 1 > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
        self.ids[self.used : self.used + len(flat)] = flat
        self.starts[n + 1 : n + 1 + len(pieces)] = self.used + np.cumsum(counts)
        self.used += len(flat)
        self.known.update(zip(whole + other, range(n, n + len(pieces))))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.fits:
            return [np.array(code.ids, np.uint32) for code in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        whole = [k for k, t in enumerate(texts) if self.special and self.special.search(t)]
        if whole:  # a special token's string is matched in the whole text first
            rest = iter(self.encode(["" if self.special.search(t) else t for t in texts]))
            return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) if self.special.search(t) else x for t, x in zip(texts, rest)]
        pieces: list[str] = []
        ends = []
        for text in texts:
            pieces += _PIECE.findall(text)
            ends.append(len(pieces))
        new = list(set(pieces).difference(self.known))
        if len(self.known) + len(new) > CACHE:
            self._reset()
            new = list(set(pieces))
        if new:
            self._learn(new)
        nums = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        first, count = self.starts[nums], self.starts[nums + 1] - self.starts[nums]
        before = np.concatenate(([0], np.cumsum(count)))
        flat = self.ids[np.repeat(first - before[:-1], count) + np.arange(before[-1])]
        cuts = before[np.concatenate(([0], ends)).astype(np.int64)].tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


#: One encoder for each vocabulary file in a Python worker.
_encoders: dict[str, PieceEncoder] = {}
SEGMENTS = "part int, segment int, n_ids long, doc_ids binary, doc_counts binary, payload binary"


def _segments(tokenizer_file: str | None, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        path = tokenizer_file
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        if path not in _encoders:
            _encoders[path] = PieceEncoder(path)
        encoder, part, number = _encoders[path], TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        docs: list[int | None] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            flat = np.concatenate(ids)
            keys = pa.array(docs, pa.int64())
            with pa.BufferOutputStream() as sink:  # doc ids may be null
                with pa.ipc.new_stream(sink, pa.schema([("d", pa.int64())])) as w:
                    w.write_batch(pa.RecordBatch.from_arrays([keys], names=["d"]))
                packed = sink.getvalue().to_pybytes()
            counts = np.array([len(x) for x in ids], "<u8").tobytes()
            row = [[part], [number], [len(flat)], [packed], [counts], [dac_encode(flat)]]
            number += 1
            ids.clear()
            docs.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()])], names=[x.split()[0] for x in SEGMENTS.split(", ")])

        held, end = 0, np.array([end_id], np.uint32)
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                for doc, x in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
                    if held and held + len(x) + 1 > SEGMENT_IDS:
                        yield flush()
                        held = 0
                    ids.append(np.concatenate((x, end)))
                    docs.append(doc)
                    held += len(x) + 1
        if held:
            yield flush()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str | None = None, end_id: int = END_ID) -> None:
    """Encode docs (doc_id, text) and write them under path as segments, in ascending doc_id order (null first).

    Spark orders the rows by ranges of doc_id; each task encodes its range and packs it into segments, which are rows of a
    Parquet table, so that Spark's commit makes the output whole even where tasks are repeated.
    """
    rows = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(_segments(tokenizer_file, end_id), SEGMENTS).write.option("compression", "none").parquet(path)  # so a segment is read as it stands


def segment_starts(table: DataFrame) -> DataFrame:
    """part, segment, n_ids, segment_start (ids before it in the whole corpus): a running sum within each part, and one over parts."""
    sizes = table.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n_part"))
    parts = parts.select("part", F.coalesce(F.sum("n_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start"))
    inner = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "segment", "n_ids", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)).alias("s")).join(parts, "part")
    return starts.select("part", "segment", "n_ids", (F.col("s") + F.col("part_start")).alias("segment_start"))


def tokens_at(spark, path: str, places: DataFrame) -> DataFrame:
    """The ids at places (place: numbers of tokens in the corpus): place, token_id; places beyond the corpus are left out.

    Each is read alone through the rank directories of its segment: nothing is decoded.  Places meet their segments by blocks of SEGMENT_IDS.
    """
    table = spark.read.schema(SEGMENTS).parquet(path)
    starts = segment_starts(table)
    blocks = F.sequence(F.floor(F.col("segment_start") / SEGMENT_IDS), F.floor((F.col("segment_start") + F.col("n_ids") - 1) / SEGMENT_IDS))
    covered = starts.withColumn("block", F.explode(blocks))
    wanted = places.select(F.col("place").cast("long").alias("place"), F.floor(F.col("place") / SEGMENT_IDS).alias("block")).join(covered, "block")
    wanted = wanted.where("place >= segment_start AND place < segment_start + n_ids").select(F.col("part").alias("p"), F.col("segment").alias("s"), "place", (F.col("place") - F.col("segment_start")).alias("at"))

    def look(key: tuple, segment: pa.Table, asked: pa.Table) -> pa.Table:
        if not segment.num_rows or not asked.num_rows:
            return pa.table({"place": pa.array([], pa.int64()), "token_id": pa.array([], pa.int64())})
        dac = Dac(segment.column("payload")[0].as_py())
        return pa.table({"place": asked.column("place"), "token_id": pa.array([dac[i] for i in asked.column("at").to_pylist()], pa.int64())})

    chosen = wanted.select("p", "s").distinct()
    needed = table.select("part", "segment", "payload").join(chosen, (F.col("part") == F.col("p")) & (F.col("segment") == F.col("s")), "left_semi")
    return needed.groupBy("part", "segment").cogroup(wanted.groupBy("p", "s")).applyInArrow(look, "place long, token_id long")


def read_tokens(spark, path: str) -> DataFrame:
    """Every document of a token table: doc_id, start (ids before it in the whole corpus), n_tokens, ids_crc32, part, segment.

    The number of ids before each segment is a running sum in two steps: within a part, and over parts.
    """
    table = spark.read.schema(SEGMENTS).parquet(path)
    starts = segment_starts(table).drop("n_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, segment, doc_ids, counts, payload in zip(*(batch.column(k).to_pylist() for k in ("part", "segment", "doc_ids", "doc_counts", "payload"))):
                ids = Dac(payload).ids().astype("<u4")
                n = np.frombuffer(counts, "<u8").astype(np.int64)
                ends = np.cumsum(n)
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), n.tolist())]
                keys = pa.ipc.open_stream(doc_ids).read_all().column(0).combine_chunks()
                m = len(n)
                yield pa.RecordBatch.from_arrays([keys, pa.array(ends - n), pa.array(n), pa.array(crc, pa.int64()), pa.array([part] * m, pa.int32()), pa.array([segment] * m, pa.int32())], names=["doc_id", "at", "n_tokens", "ids_crc32", "part", "segment"])

    docs = table.mapInArrow(run, "doc_id long, at long, n_tokens long, ids_crc32 long, part int, segment int")
    return docs.join(starts, ["part", "segment"]).select("doc_id", (F.col("at") + F.col("segment_start")).alias("start"), "n_tokens", "ids_crc32", "part", "segment")


def token_table(docs: DataFrame, tokenizer_file: str | None = None, end_id: int = END_ID) -> DataFrame:
    """write_tokens into the shared folder and read_tokens from there.  Rows that share a doc_id, or have none, follow each other; a text of any length is encoded whole, in a segment of its own
    where it is long; a tokenizer that isn't byte-level encodes whole texts, too (slower).

    A null or empty text is its end id alone; repeated rows are written each; rows that share a doc_id follow in the order
    of their texts; an empty table gives no rows; other columns are ignored.
    """
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_file, end_id)
    return read_tokens(docs.sparkSession, path)
