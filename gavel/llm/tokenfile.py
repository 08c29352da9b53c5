"""Token-id files of directly addressable codes (operator 7).

A file holds segments. A segment splits its ids into chunks of 8 bits: level 0
has the low chunk of every id, level k the next chunk of those ids that go on,
in the same order. A bitmap of each level but the last tells which ids go on,
and a rank directory counts them before each block of bits, so token i is found
by one look and one rank a level, without decoding a block. Any id up to 2**32
fits; ids below 256 take one byte and a bit.

    file     segments..., index (Arrow IPC: one row a document), footer
    segment  levels, count; per level: size of its chunks, bitmap and ranks
    footer   place and size of the segment table, of the index, and a mark

Documents are range-partitioned by doc_id and written in that order, one file a
partition, straight to the shared folder through Arrow's file systems. A task
attempt writes a file of its own name and reports it in a row; only reported
files count, so a lost or repeated task leaves nothing but an unused file.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.llm.tables import stored
from gavel.llm.words import slices, texts_of
from gavel.llm.wordtokens import word_tokens

MARK = b"DACTOK01"
RANK_BITS = 512  # bits a rank entry covers
HEAD, SIZES, TAIL = struct.Struct("<IQ"), struct.Struct("<QQQ"), struct.Struct("<QQQQ8s")


class Codes:
    """One segment: chunk levels, continuation bitmaps and rank directories."""

    def __init__(self, levels: list[np.ndarray], bits: list[np.ndarray], ranks: list[np.ndarray], count: int) -> None:
        self.levels, self.bits, self.ranks, self.count = levels, bits, ranks, count

    @classmethod
    def of(cls, ids: np.ndarray) -> Codes:
        levels, bits, ranks = [], [], []
        rest = ids.astype(np.uint32)
        while True:
            levels.append((rest & 255).astype(np.uint8))
            more = rest > 255
            if not more.any():
                return cls(levels, bits, ranks, len(ids))
            packed = np.packbits(more, bitorder="little")
            pad = np.zeros(-len(more) % RANK_BITS, bool)
            blocks = np.concatenate([more, pad]).reshape(-1, RANK_BITS).sum(axis=1, dtype=np.int64)
            bits.append(packed)
            ranks.append((np.cumsum(blocks) - blocks).astype("<u4"))
            rest = rest[more] >> np.uint32(8)

    def token(self, i: int) -> int:
        """Token i, by one look and one rank a level."""
        value = 0
        for k, level in enumerate(self.levels):
            value |= int(level[i]) << (8 * k)
            if k == len(self.bits) or not self.bits[k][i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            near = self.bits[k][block * RANK_BITS // 8 : (i >> 3) + 1].copy()
            near[-1] &= (1 << (i & 7)) - 1
            i = int(self.ranks[k][block]) + int(np.bitwise_count(near).sum())
        return value

    def all(self) -> np.ndarray:
        """All ids in order."""
        out = self.levels[0].astype(np.uint32)
        at = np.arange(self.count)
        for k, bits in enumerate(self.bits):
            at = at[np.unpackbits(bits, count=len(at), bitorder="little").view(bool)]
            out[at] |= self.levels[k + 1].astype(np.uint32) << np.uint32(8 * (k + 1))
        return out

    def write(self, out) -> None:
        out.write(HEAD.pack(len(self.levels), self.count))
        for k, level in enumerate(self.levels):
            last = k == len(self.bits)
            parts = [level, np.empty(0, np.uint8) if last else self.bits[k], np.empty(0, "<u4") if last else self.ranks[k]]
            out.write(SIZES.pack(*[x.nbytes for x in parts]))
            for x in parts:
                out.write(x.tobytes())

    @classmethod
    def read(cls, data) -> Codes:
        data = memoryview(data)
        n, count = HEAD.unpack_from(data)
        at = HEAD.size
        levels, bits, ranks = [], [], []
        for k in range(n):
            sizes = SIZES.unpack_from(data, at)
            at += SIZES.size
            for into, size, kind in zip((levels, bits, ranks), sizes, (np.uint8, np.uint8, "<u4")):
                if into is levels or k < n - 1:
                    into.append(np.frombuffer(data[at : at + size], kind))
                at += size
        return cls(levels, bits, ranks, count)


class TokenWriter:
    """Writes one file: `add` a segment with its documents, then `close`."""

    def __init__(self, stream) -> None:
        self.stream, self.at = stream, 0
        self.segments: list[tuple[int, int, int]] = []  # place, size, tokens before
        self.docs: list[pa.RecordBatch] = []
        self.tokens = 0

    def _put(self, data: bytes) -> int:
        self.stream.write(data)
        self.at += len(data)
        return len(data)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        out = io.BytesIO()
        Codes.of(ids).write(out)
        self.segments.append((self.at, self._put(out.getvalue()), self.tokens))
        self.docs.append(pa.RecordBatch.from_arrays([doc_ids.cast(pa.int64()), pa.array(sizes.astype(np.int64))], ["doc_id", "n"]))
        self.tokens += len(ids)

    def close(self) -> None:
        table = np.array(self.segments, "<u8").reshape(-1, 3)
        segments = (self.at, self._put(table.tobytes()))
        sink = io.BytesIO()
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64())])
        with pa.ipc.new_stream(sink, schema) as writer:
            for batch in self.docs:
                writer.write_batch(batch)
        index = (self.at, self._put(sink.getvalue()))
        self._put(TAIL.pack(*segments, *index, MARK))


class TokenFile:
    """Reads one file by range reads: any token, or its segments in order."""

    def __init__(self, stream) -> None:
        self.stream = stream
        size = stream.size()
        a, n, b, m, mark = TAIL.unpack(self._get(size - TAIL.size, TAIL.size))
        if mark != MARK:
            raise ValueError("not a token file")
        self.segments = np.frombuffer(self._get(a, n), "<u8").reshape(-1, 3)
        with pa.ipc.open_stream(self._get(b, m)) as reader:
            self.docs = list(reader)
        self._open: tuple[int, Codes | None] = (-1, None)

    def _get(self, at: int, size: int) -> bytes:
        self.stream.seek(int(at))
        return self.stream.read(int(size))

    def segment(self, k: int) -> Codes:
        if self._open[0] != k:
            self._open = (k, Codes.read(self._get(*self.segments[k][:2])))
        return self._open[1]

    def token(self, i: int) -> int:
        """Token i of the file."""
        k = int(np.searchsorted(self.segments[:, 2], i, side="right")) - 1
        return self.segment(k).token(i - int(self.segments[k, 2]))

    def __iter__(self) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        for k, docs in enumerate(self.docs):
            yield docs, self.segment(k).all()


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_tokens(docs: DataFrame, folder: str, file: str, end: int = 2) -> DataFrame:
    """Files of the token ids of `docs` (doc_id, text) in ascending doc_id order; a row (part, path, n_tokens) for each.

    A null text is empty and gives the end id alone. Rows without doc_id come
    first; rows that repeat a doc_id are written next to each other, in the
    order of their texts' hashes. An empty table gives no file.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(file)
        writer = stream = None
        for part in slices(batches):
            if writer is None:
                task = TaskContext.get().partitionId()
                path = f"{folder}/part-{task:06d}-{uuid.uuid4().hex}.tok"
                system, place = _opened(path)
                system.create_dir(place.rpartition("/")[0], recursive=True)
                stream = system.open_output_stream(place)
                writer = TokenWriter(stream)
            ids, bounds, _ = tokens.encode(texts_of(part), end)
            writer.add(part.column("doc_id"), ids, np.diff(bounds))
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([task], pa.int32()), pa.array([path]), pa.array([writer.tokens], pa.int64())], ["part", "path", "n_tokens"]
            )

    return stored(ordered.mapInArrow(run, "part int, path string, n_tokens long"), "files")


def read_tokens(spark: SparkSession, files: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document in the files, read back from them."""
    # One row a file: as many as the writing job had tasks.
    listed = files.orderBy("part").collect()
    starts, before = [], 0
    for row in listed:
        starts.append((row.path, before))
        before += row.n_tokens
    kinds = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                system, place = _opened(path)
                with system.open_input_file(place) as stream:
                    for docs, ids in TokenFile(stream):
                        raw = memoryview(ids.astype("<u4").tobytes())
                        size = docs.column("n").to_numpy()
                        bounds = np.concatenate(([0], np.cumsum(size)))
                        each = [raw[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                        columns = [docs.column("doc_id"), pa.array(start + bounds[:-1]), docs.column("n"),
                                   pa.array([zlib.crc32(x) for x in each], pa.int64())]
                        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                        if with_ids:
                            columns.append(pa.array([bytes(x) for x in each], pa.binary()))
                            names.append("ids")
                        yield pa.RecordBatch.from_arrays(columns, names)
                        start += len(ids)

    table = spark.createDataFrame(starts, "path string, start long")
    return table.repartition(max(1, len(starts)), "path").mapInArrow(run, kinds)
