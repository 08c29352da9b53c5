"""Byte-level BPE encoding and decoding on padded matrices (operator 4).

A text is cut at single spaces between two other characters, where the split
pattern always has a boundary, so each distinct unit is split by the pattern
once and each distinct match is merged once. Matches of similar length are rows
of a padded matrix: in each round every row merges its leftmost pair of least
rank, pairs are looked up in a hash table, and the row is compacted. Rows that
are done leave the matrix. Decoding joins the bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavel.llm.ragged import RunCache
from gavel.llm.words import slices, texts_of

NONE = np.int32(2**31 - 1)
WIDEST = 256  # longer matches are merged one by one, with a heap
ROWS = 1 << 16  # rows of a matrix
# Characters that some engine takes for white space.
SPACE = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


class PairTable:
    """(left id, right id) to the id of both joined: open addressing in two arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, value: np.ndarray) -> None:
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(value)) * 4))))
        self.mask = (1 << self.bits) - 1
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.value = np.full(1 << self.bits, NONE, np.int32)
        key = left.astype(np.int64) << 32 | right
        slot = self._slot(key)
        todo = np.arange(len(key))
        while len(todo):
            free = self.key[slot[todo]] < 0
            self.key[slot[todo[free]]] = key[todo[free]]  # of several the last stays
            won = self.key[slot[todo]] == key[todo]
            self.value[slot[todo[won]]] = value[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the joined pairs, NONE where there is none (also for padding, which is negative)."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        key[(left < 0) | (right < 0)] = -2
        slot = self._slot(key)
        out = np.full(len(key), NONE, np.int32)
        todo = np.flatnonzero(key >= 0)
        while len(todo):
            there = self.key[slot[todo]]
            hit = there == key[todo]
            out[todo[hit]] = self.value[slot[todo[hit]]]
            todo = todo[~hit & (there >= 0)]
            slot[todo] = (slot[todo] + 1) & self.mask
        return out


class ByteBpe:
    """Encodes and decodes by a rank file; `pattern` splits texts before the merges."""

    def __init__(self, file: str, pattern: str) -> None:
        import regex

        with open(file, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.rank = {base64.b64decode(token): int(i) for token, i in pairs}
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        left, right, value = [], [], []
        for token, i in self.rank.items():
            for cut in range(1, len(token)):
                a, b = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    value.append(i)
        self.pairs = PairTable(np.array(left, np.int64), np.array(right, np.int64), np.array(value, np.int32))
        self.bytes_of: list[bytes] = [b""] * (max(self.rank.values()) + 1)
        for token, i in self.rank.items():
            self.bytes_of[i] = token
        self.digits = [str(i).encode() for i in range(len(self.bytes_of))]
        self.split = regex.compile(pattern).findall
        self.matches = RunCache(self._merge)
        self.units = RunCache(self._split)

    def _split(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = self.split
        parts = [split(u) for u in units]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        rows = self.matches.rows([m for p in parts for m in p])
        ids = self.matches.joined(rows)
        size = np.concatenate(([0], np.cumsum(self.matches.length[rows], dtype=np.int64)))
        ends = np.cumsum(counts)
        return ids, size[ends] - size[ends - counts]

    def _merge(self, matches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data = [m.encode() for m in matches]
        size = np.fromiter(map(len, data), np.int64, len(data))
        start = np.cumsum(size) - size
        raw = self.byte[np.frombuffer(b"".join(data), np.uint8)]
        out = np.empty(len(raw), np.int32)  # merged ids never need more room
        length = size.copy()
        order = np.argsort(size, kind="stable")
        wide = order[size[order] > WIDEST]
        order = order[: len(order) - len(wide)]
        at = 0
        while at < len(order):
            # A bucket: rows of up to 1.25 times the least length, so little of the matrix is padding.
            least = size[order[at]]
            end = min(np.searchsorted(size[order], max(least + 1, least * 5 // 4 + 1)), at + ROWS)
            rows = order[at:end]
            at = end
            width = int(size[rows[-1]])
            column = np.arange(width)
            inside = column < size[rows][:, None]
            ids = np.full((len(rows), width), -1, np.int32)
            ids[inside] = raw[(start[rows][:, None] + column)[inside]]
            ids = self._merged(ids)
            count = (ids >= 0).sum(axis=1)
            length[rows] = count
            kept = np.arange(ids.shape[1]) < count[:, None]
            out[(start[rows][:, None] + np.arange(ids.shape[1]))[kept]] = ids[kept]
        for r in wide:
            ids = self._long(raw[start[r] : start[r] + size[r]])
            length[r] = len(ids)
            out[start[r] : start[r] + len(ids)] = ids
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        return out[np.repeat(start - (ends - length), length) + np.arange(total)], length

    def _merged(self, ids: np.ndarray) -> np.ndarray:
        """Every row of a padded matrix merged to its end."""
        n, width = ids.shape
        done = ids.copy()
        if width < 2:
            return done
        place = np.arange(n)
        rank = self.pairs.find(ids[:, :-1].reshape(-1), ids[:, 1:].reshape(-1)).reshape(n, width - 1)
        while True:
            at = rank.argmin(axis=1)  # the leftmost of the least
            best = rank[np.arange(len(place)), at]
            live = best != NONE
            if not live.all():
                stop = ~live
                done[place[stop], : ids.shape[1]] = ids[stop]
                done[place[stop], ids.shape[1] :] = -1
                place, ids, rank, at, best = place[live], ids[live], rank[live], at[live], best[live]
            if not len(place):
                return done
            row = np.arange(len(place))
            ids[row, at] = best
            # Close the gap behind the merged id; one column goes in each round.
            column = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)
            if ids.shape[1] < 2:
                done[place, :1] = ids
                done[place, 1:] = -1
                return done
            column = np.arange(rank.shape[1] - 1)
            rank = np.take_along_axis(rank, column + (column >= at[:, None] + 1), axis=1)
            left = at > 0
            rank[row[left], at[left] - 1] = self.pairs.find(ids[row[left], at[left] - 1], ids[row[left], at[left]])
            right = at < ids.shape[1] - 1
            rank[row[right], at[right]] = self.pairs.find(ids[row[right], at[right]], ids[row[right], at[right] + 1])

    def _long(self, ids: np.ndarray) -> list[int]:
        """One long match, its pairs in a heap by (rank, place)."""
        ids = ids.tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.pairs.find(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(rank) if r != NONE]
        heapq.heapify(heap)
        token, bytes_of = self.rank, self.bytes_of

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n:
                r = token.get(bytes_of[ids[i]] + bytes_of[ids[j]])
                if r is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i] = r
            ids[j] = -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the place where each text starts (and the end)."""
        cut = pc.split_pattern(texts, " ")
        coded = cut.flatten().dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        bounds = cut.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        odd = pc.match_substring_regex(coded.dictionary, f"^[{SPACE}]|[{SPACE}]$|^$").to_numpy(zero_copy_only=False)[code]
        pieces = coded.dictionary.to_pylist()
        # A unit starts with a text and at each space that has no white space on either side.
        fresh = np.ones(len(code), bool)
        fresh[1:] = ~(odd[1:] | odd[:-1])
        first = np.zeros(len(code), bool)
        first[bounds[:-1]] = True
        fresh |= first
        starts = np.flatnonzero(fresh)
        ends = np.append(starts[1:], len(code))
        single = (ends - starts == 1) & ~first[starts]
        rows = np.empty(len(starts), np.int64)
        used = np.unique(code[starts[single]])
        special = [
            ("" if f else " ") + " ".join([pieces[c] for c in code[a:b].tolist()])
            for a, b, f in zip(starts[~single].tolist(), ends[~single].tolist(), first[starts[~single]].tolist())
        ]
        own = self.units.rows([" " + pieces[c] for c in used.tolist()] + special)
        place = np.zeros(len(pieces), np.int64)
        place[used] = own[: len(used)]
        rows[single] = place[code[starts[single]]]
        rows[~single] = own[len(used) :]
        size = np.concatenate(([0], np.cumsum(self.units.length[rows], dtype=np.int64)))
        return self.units.joined(rows), size[np.searchsorted(starts, bounds)]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


@cache
def byte_bpe(file: str, pattern: str) -> ByteBpe:
    """One codec per Python worker."""
    return ByteBpe(file, pattern)


def encoded(docs: DataFrame, file: str, pattern: str, digests: bool = False) -> DataFrame:
    """`docs` (doc_id, text) as doc_id, n_tokens and ids (array), decoded (binary), or their SHA-256 with `digests`.

    A null text is empty and has no ids. Repeated rows and rows without doc_id
    are encoded like any other; an empty table gives an empty result. decoded
    is made from the ids alone.
    """
    out = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded binary"
    schema = T._parse_datatype_string(f"doc_id long, n_tokens long, {out}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_bpe(file, pattern)
        for part in slices(batches):
            ids, bounds = codec.encode(texts_of(part))
            one, two = [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                own = ids[a:b]
                decoded = codec.decode(own)
                if digests:
                    text = b" ".join(map(codec.digits.__getitem__, own.tolist()))
                    one.append(hashlib.sha256(text).hexdigest())
                    two.append(hashlib.sha256(decoded).hexdigest())
                else:
                    one.append(own)
                    two.append(decoded)
            kinds = (pa.string(), pa.string()) if digests else (pa.list_(pa.int32()), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(np.diff(bounds)), pa.array(one, kinds[0]), pa.array(two, kinds[1])],
                schema.names,
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
