"""Working tables in the shared folder, and small bitmaps merged from all tasks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.session import work_folder

BLOCK_BITS = 19  # bits of a bitmap that one row of the merge holds


ROWS_A_FILE = 100_000  # of working tables whose size is known before they are written
_made: ContextVar[dict[str, DataFrame] | None] = ContextVar("made", default=None)  # folders of the tables of the open scope


def stored(df: DataFrame, label: str, most: int | None = None) -> DataFrame:
    """`df` written once to the shared folder and read back: cuts the lineage and survives lost executors.

    `most` is a known bound of the rows; a table that can only be small then
    takes few files, and Spark can tell that it may broadcast it.
    """
    path = work_folder(df.sparkSession, label)
    if most is not None:
        df = df.coalesce(1 + most // ROWS_A_FILE)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    if (made := _made.get()) is not None:
        made[path] = out
    return out


@contextmanager
def working_tables(keep: list[DataFrame]) -> Iterator[None]:
    """Deletes the tables stored inside when they are no longer needed: at the end, all but those in `keep`.

    What is kept passes to the scope around this one, if any. Results that are
    not computed yet may read kept tables only. If the block fails, its tables
    stay. Shared folders that Arrow has no file system for are left to their owner.
    """
    outer, own = _made.get(), {}
    token = _made.set(own)
    try:
        yield
    finally:
        _made.reset(token)
    for path, table in own.items():
        if any(table is k for k in keep):
            if outer is not None:
                outer[path] = table
        else:
            _delete(path)


def _delete(path: str) -> None:
    try:
        files, name = FileSystem.from_uri(path)
    except pa.ArrowInvalid:  # no such kind of file system
        return
    files.delete_dir(name)


def dropped(table: DataFrame) -> None:
    """Deletes a table of the open scope before its end."""
    made = _made.get() or {}
    for path in [p for p, t in made.items() if t is table]:
        del made[path]
        _delete(path)


def empty(df: DataFrame) -> bool:
    return not df.take(1)


def bitmap(keys: DataFrame, bits: int, hashed: bool = True) -> np.ndarray:
    """A bitmap of 2**bits places with those of the first column's hash set (or of the column itself, if it is a hash).

    Tasks set their own bits; blocks of the partial bitmaps are merged by key.
    What reaches the driver is 2**bits / 8 bytes at most, whatever the keys.
    """
    own = F.xxhash64(keys.columns[0]) if hashed else F.col(keys.columns[0])
    places = keys.select(F.pmod(own, F.lit(1 << bits)).alias("place"))
    block = min(bits, BLOCK_BITS)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            place = np.unique(batch.column(0).to_numpy(zero_copy_only=False))
            which = place >> block
            for b in np.unique(which):
                own.setdefault(int(b), np.zeros(1 << block, bool))[place[which == b] & ((1 << block) - 1)] = True
        for b, flags in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([b]), pa.array([np.packbits(flags).tobytes()])], ["block", "flags"])

    def merged(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << block) // 8, np.uint8)
        for batch in batches:
            for flags in batch.column("flags"):
                total |= np.frombuffer(flags.as_buffer(), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([total.tobytes()])], ["block", "flags"])

    kinds = "block long, flags binary"
    out = np.zeros(max(1, (1 << bits) // 8), np.uint8)
    width = (1 << block) // 8
    for row in places.mapInArrow(local, kinds).groupBy("block").applyInArrow(merged, kinds).collect():
        out[row.block * width : (row.block + 1) * width] = np.frombuffer(row.flags, np.uint8)
    return out


def place_of(key: Column, bits: int) -> Column:
    """The place of a key in such a bitmap."""
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def marked(flags: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which places are set."""
    return (flags[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1


def components(edges: DataFrame) -> DataFrame:
    """node, label (the least node reachable) of every node of the undirected edges (a, b).

    Each round takes the least label among the neighbours and then the label of
    that label, so the rounds grow with the logarithm of the longest path. Both
    are aggregates and joins on keys, which a hub with many links doesn't
    gather in one task; every round is a stored table.
    """
    edges = edges.select("a", "b")
    most = 2 * edges.count()
    both = stored(edges.union(edges.select("b", "a")).distinct(), "links", most)
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    labels = stored(labels, "labels", most)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        new = stored(step.join(up, "label").select("node", "old", F.least("label", "above").alias("label")), "labels", most)
        if empty(new.where("old <> label")):
            return new.select("node", "label")
        labels = new.select("node", "label")

