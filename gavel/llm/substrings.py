"""Substring removal behind a count-min prefilter (operator 6).

A window is `window` consecutive words. A word goes if it lies in a window
whose words also start in a text with a smaller doc_id.

1. Texts that equal another text word by word leave all their words to the one
   with the smallest doc_id, which stands for them from here on.
2. Every task counts, in a count-min sketch, in how many texts each window
   occurs. Of a window only its anchor is counted: the run of `anchor` words
   in it with the least hash. Neighbouring windows mostly share their anchor,
   so there are several times fewer counts than windows, and a window's
   estimate is still never below its true count. A task hands on its non-zero
   cells only; sketches merge by block.
3. A second pass over the texts sends on only windows estimated to be in two
   texts or more, by a 96-bit hash, and groups these exactly: the least doc_id
   of each window. A window that repeats is never lost; one that doesn't only
   costs a row.
4. Windows with a smaller first text go back to their own text as word ranges.
   Only texts that lose words are shuffled.

The sketch grows with the corpus up to 2**MOST_BITS cells a row, which bounds
what is broadcast; beyond that more windows pass the filter and the exact pass,
an aggregate and a join on the window's hash, does more of the work. The bitmaps
of rows are of a fixed size and only choose between two ways to one result.

A row is named by doc_id and a hash of id and text: rows with one id and
different texts are judged each by its own words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavel.llm.tables import bitmap, marked, place_of, stored, working_tables
from gavel.llm.words import Words, inside, mixed, rolling, slices, texts_of, tidied

LEAST_BITS, MOST_BITS = 20, 27  # cells of a sketch row, as a power of two
BYTES_A_CELL = 4  # bytes of text for a cell; a text has about one anchor in 20 bytes
ROWS = 3
BLOCK_BITS = 20  # cells that one row of the merge holds, as a power of two
TASK_CELLS = 1 << 21  # cells after which a task hands on its sketch
GAP = (1 << 14) - 1  # longest step between two cells of a handed-on list
FILTER_BITS = 26  # bitmaps of rows: 8 MB each
ROW = ["doc_id", "__row"]  # names a text of a doc_id
# Odd multipliers, one a row.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
PART = 1 << 20  # text whose words and windows are held at a time


@dataclass(frozen=True)
class SubstringParams:
    window: int = 13
    anchor: int = 8


def _bits(size: int) -> int:
    return int(min(MOST_BITS, max(LEAST_BITS, np.ceil(np.log2(max(size, 1) / BYTES_A_CELL)))))


class _Windows:
    """Windows of a slice: hashes and anchors of those that lie in one text, with their places."""

    def __init__(self, texts: pa.Array, params: SubstringParams) -> None:
        self.words = words = Words(texts)
        n = params.window
        h = mixed(words.hashes())
        self.at = np.flatnonzero(inside(words.start, n, len(words)))
        self.doc = words.doc[self.at] if len(self.at) else np.empty(0, np.int64)
        self.value = h
        self.n = n
        anchors = mixed(rolling(h, params.anchor))
        least = anchors[: max(0, len(words) - n + 1)].copy()
        for j in range(1, n - params.anchor + 1):
            np.minimum(least, anchors[j : j + len(least)], out=least)
        self.anchor = least[self.at]

    def keys(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the windows at the chosen places (the second of 32 bits)."""
        first = mixed(rolling(self.value, self.n))
        second = mixed(rolling(mixed(self.value ^ np.uint64(0xA5A5A5A5A5A5A5A5)), self.n)) >> np.uint64(32)
        at = self.at[which]
        return first[at].view(np.int64), second[at].astype(np.uint32).view(np.int32)


def _cells(anchor: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    with np.errstate(over="ignore"):
        return [((anchor * MULTIPLIERS[row]) >> np.uint64(64 - bits) & mask).astype(np.int64) for row in range(ROWS)]


def _stepped(cells: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending cells with counts of 1 to 3, as 16-bit steps; a step too long is taken in parts with count 0."""
    step = np.diff(cells, prepend=0)
    extra = step // (GAP + 1)
    at = np.arange(len(cells)) + np.cumsum(extra)
    out = np.full(len(cells) + int(extra.sum()), (GAP << 2) & 0xFFFF, np.uint16)
    out[at] = (step - extra * GAP) << 2 | counts
    return out.tobytes()


def _cells_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(data, np.uint16)
    cells = np.cumsum(raw >> 2, dtype=np.int64)
    real = (raw & 3) > 0
    return cells[real], (raw & 3)[real].astype(np.uint8)


def repeated_cells(rows: DataFrame, bits: int, params: SubstringParams, chosen) -> np.ndarray:
    """ROWS bitmaps (one after the other) of cells counted in two texts or more: 2**bits / 8 bytes each."""
    size = 1 << bits
    block = 1 << min(BLOCK_BITS, bits)

    def handed(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        cells = np.concatenate(parts)
        parts.clear()
        cells.sort()
        # Counted block by block: wide numbers are those of one block only.
        cuts = np.searchsorted(cells, np.arange(0, ROWS * size + 1, block, dtype=np.uint32))
        for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
            if j > i:
                own = cells[i:j].astype(np.int64) - b * block
                first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                data = _stepped(own[first], np.minimum(np.diff(np.append(first, len(own))), 3))
                yield pa.RecordBatch.from_arrays([pa.array([b]), pa.array([data], pa.binary())], ["block", "counts"])

    @tidied
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for part in slices(chosen(batches), PART):
            found = _Windows(texts_of(part), params)
            for row, cell in enumerate(_once(found, bits)):
                parts.append((cell + row * size).astype(np.uint32))
                held += len(cell)
            if held > TASK_CELLS:
                yield from handed(parts)
                parts, held = [], 0
        yield from handed(parts)

    def merged(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(block, np.uint8)
        for batch in batches:
            for data in batch.column("counts").to_pylist():
                cells, counts = _cells_of(data)
                total[cells] = np.minimum(total[cells] + counts, 3)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([np.packbits(total >= 2).tobytes()])], ["block", "flags"])

    partial = rows.mapInArrow(local, "block long, counts binary")
    out = np.zeros(ROWS * size // 8, np.uint8)
    width = block // 8
    for row in partial.groupBy("block").applyInArrow(merged, "block long, flags binary").toLocalIterator():
        out[row.block * width : (row.block + 1) * width] = np.frombuffer(row.flags, np.uint8)
    return out


def _once(found: _Windows, bits: int) -> list[np.ndarray]:
    """Cells of each text's distinct anchors."""
    if not len(found.at):
        return []
    # Neighbouring windows repeat their anchor; what is left is made distinct by text.
    new = np.concatenate(([True], (found.anchor[1:] != found.anchor[:-1]) | (found.doc[1:] != found.doc[:-1])))
    anchor, doc = found.anchor[new], found.doc[new]
    key = np.argsort(anchor + mixed(doc.astype(np.uint64) + np.uint64(1)))
    anchor, doc = anchor[key], doc[key]
    first = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])))
    return _cells(anchor[first], bits)


def _estimated(found: _Windows, flags: np.ndarray, bits: int) -> np.ndarray:
    """Which windows are estimated to be in two texts or more."""
    keep = np.ones(len(found.at), bool)
    width = (1 << bits) // 8
    for row, cell in enumerate(_cells(found.anchor, bits)):
        own = flags[row * width : (row + 1) * width]
        keep &= (own[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    return np.flatnonzero(keep)


def _chooser(flags: np.ndarray | None, want: bool):
    """Keeps rows whose place is marked (or isn't), and those that are `sure`."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if flags is not None:
                hit = marked(flags, batch.column("__place").to_numpy(zero_copy_only=False)) == want
                batch = batch.filter(pa.array(hit | batch.column("__sure").to_numpy(zero_copy_only=False)))
            yield batch

    return chosen


def _named(docs: DataFrame) -> DataFrame:
    """`docs` with __row, which tells the texts of one doc_id apart."""
    return docs.withColumn("__row", F.xxhash64(F.col("doc_id").cast("long"), "text"))


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, __row, text of the rows that have both id and text."""
    rows = _named(docs).where("doc_id is not null and text is not null")
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "__row", "text")


def _placed(docs: DataFrame, sure: bool = False) -> DataFrame:
    return docs.withColumns({"__place": place_of(F.col("__row"), FILTER_BITS), "__sure": F.lit(sure)})


def _wholes(docs: DataFrame) -> DataFrame:
    """doc_id, __row, n_words, words (digest of the word sequence) of every text."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, PART):
            words = [t.split() for t in texts_of(part).cast(pa.binary()).to_pylist()]
            digests = [xxhash.xxh3_128_digest(b" ".join(w)) for w in words]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("__row"), pa.array([len(w) for w in words], pa.int64()), pa.array(digests, pa.binary())],
                [*ROW, "n_words", "words"],
            )

    return _texts(docs).mapInArrow(run, "doc_id long, __row long, n_words long, words binary")


def _filtered(docs: DataFrame, columns: list[str], flags: np.ndarray, want: bool) -> DataFrame:
    """Rows of `docs` whose __row the bitmap marks (or doesn't)."""
    schema = T.StructType([docs.schema[c] for c in columns])
    chosen = _chooser(flags, want)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(chosen(batches), PART):
            yield part.select(columns)

    return _placed(docs).mapInArrow(run, schema)


def copies_of(docs: DataFrame, params: SubstringParams) -> DataFrame:
    """doc_id, __row of texts of a window or more that equal, word by word, a text with a smaller doc_id."""
    whole = stored(_wholes(docs), "wholes").where(F.col("n_words") >= params.window)
    first = whole.groupBy("words").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("last > first")
    first = stored(first.select("words", "first"), "first_copies")
    return stored(whole.join(first, "words").where("doc_id > first").select(*ROW).distinct(), "copies")


def repeated_ranges(docs: DataFrame, copies: DataFrame, params: SubstringParams = SubstringParams()) -> DataFrame:
    """doc_id, __row, places: where windows start in a text whose words start in a text with a smaller doc_id, too.

    Texts named in `copies` are left out: an equal text stands for them.
    """
    rows = _texts(docs)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = _bits(size)
    flags = bitmap(copies.select("__row"), FILTER_BITS)
    # Texts that the bitmap takes for copies and that aren't: few, and put back exactly.
    strays = stored(_filtered(rows, [*ROW, "text"], flags, True).join(copies, ROW, "left_anti"), "strays")
    rows = _placed(rows).union(_placed(strays, True))
    chosen = _chooser(flags, False)
    cells = rows.sparkSession.sparkContext.broadcast(repeated_cells(rows, bits, params, chosen))

    @tidied
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(chosen(batches), PART):
            found = _Windows(texts_of(part), params)
            which = _estimated(found, cells.value, bits)
            if not len(which):
                continue
            one, two = found.keys(which)
            doc = found.doc[which]
            place = found.at[which] - found.words.start[doc]
            ids, own = (part.column(c).to_numpy(zero_copy_only=False) for c in ROW)
            yield pa.RecordBatch.from_arrays(
                [pa.array(one), pa.array(two), pa.array(ids[doc]), pa.array(own[doc]), pa.array(place.astype(np.int32))],
                ["one", "two", *ROW, "place"],
            )

    # Made twice, for the aggregate and for the join: cheaper than storing every window.
    passed = rows.mapInArrow(windows, "one long, two int, doc_id long, __row long, place int")
    first = (
        passed.groupBy("one", "two")
        .agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("one", "two", "first")
    )
    # A table of its own, so that adaptive execution can split a window that very many texts have.
    first = stored(first, "first")
    later = passed.join(first, ["one", "two"]).where(F.col("doc_id") > F.col("first"))
    # One text's places at most: bounded by the text itself.
    places = stored(later.groupBy(*ROW).agg(F.sort_array(F.collect_set("place")).alias("places")), "places")
    cells.destroy()
    return places


def _kept(texts: pa.Array, places: pa.Array | None, whole: np.ndarray, window: int) -> Iterator[tuple[int, list[bytes], np.ndarray | None]]:
    """Words, and which of them go (None: none), of every text."""
    for i, text in enumerate(texts.cast(pa.binary()).to_pylist()):
        words = text.split()
        if whole[i] and len(words) >= window:
            yield len(words), words, np.ones(len(words), bool)
        elif places is not None and places[i].is_valid:
            gone = np.zeros(len(words) + 1, np.int32)
            at = places[i].values.to_numpy(zero_copy_only=False)
            np.add.at(gone, at, 1)
            np.add.at(gone, at + window, -1)
            yield len(words), words, np.cumsum(gone[:-1]) > 0
        else:
            yield len(words), words, None


def without_repeats(docs: DataFrame, params: SubstringParams = SubstringParams(), text_out: bool = False) -> DataFrame:
    """`docs` with n_words, n_removed and kept_sha256; `text_out` replaces text by what is kept.

    Windows are judged on the input. Null texts have no words (and stay null
    in `text_out`); texts shorter than a window, and rows without doc_id, lose
    nothing; of equal texts the one with the smallest doc_id stays whole. Rows
    that repeat a doc_id take nothing from each other, and each loses what its
    own text shares with smaller doc_ids. A text that loses nothing stays as it
    is; otherwise its kept words are joined by one space. An empty table gives
    an empty result.
    """
    names = ["n_words", "n_removed", "kept_sha256"]
    carried = [c for c in docs.columns if c not in names and (text_out or c != "text")]
    added = T._parse_datatype_string("n_words long, n_removed long, kept_sha256 string")
    schema = T.StructType([docs.schema[c] for c in carried] + list(added))
    keep: list[DataFrame] = []
    with working_tables(keep):
        copies = copies_of(docs, params)
        places = repeated_ranges(docs, copies, params)
        keep += [copies, places]
    losing = copies.select(*ROW, F.lit(True).alias("whole"), F.lit(None).cast("array<int>").alias("places")).union(
        places.select(*ROW, F.lit(False).alias("whole"), "places")
    )
    losing = losing.groupBy(*ROW).agg(F.max("whole").alias("whole"), F.first("places", ignorenulls=True).alias("places"))
    flags = bitmap(losing.select("__row"), FILTER_BITS)
    columns = carried + ["__row"] if text_out else carried + ["text", "__row"]
    rows = _named(docs)

    def result(part: pa.RecordBatch, places: pa.Array | None, whole: np.ndarray) -> pa.RecordBatch:
        count, removed, digests, new = [], [], [], []
        for n, words, gone in _kept(texts_of(part), places, whole, params.window):
            lost = int(gone.sum()) if gone is not None else 0
            kept = b" ".join(words if not lost else [w for w, g in zip(words, gone.tolist()) if not g])
            if text_out:
                new.append(kept.decode() if lost else None)
            count.append(n)
            removed.append(lost)
            digests.append(hashlib.sha256(kept).hexdigest())
        out = {c: part.column(c) for c in carried}
        if text_out:
            out["text"] = pc.coalesce(pa.array(new, pa.string()), part.column("text").cast(pa.string()))
        more = [pa.array(count, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
        return pa.RecordBatch.from_arrays([out[c] for c in carried] + more, carried + names)

    chosen = _chooser(flags, False)

    @tidied
    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(chosen(batches), PART):
            yield result(part, None, np.zeros(part.num_rows, bool))

    @tidied
    def losers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, PART):
            whole = pc.fill_null(part.column("__whole"), False).to_numpy(zero_copy_only=False)
            yield result(part, part.column("__places"), whole)

    lost = losing.select(F.col("doc_id").alias("__id"), "__row", F.col("whole").alias("__whole"), F.col("places").alias("__places"))
    touched = _filtered(rows, columns, flags, True).alias("d").join(
        lost.alias("l"), (F.col("d.doc_id") == F.col("l.__id")) & (F.col("d.__row") == F.col("l.__row")), "left"
    ).select("d.*", "__whole", "__places")
    return _placed(rows.select(*columns)).mapInArrow(untouched, schema).union(touched.mapInArrow(losers, schema))
