"""Near-duplicates by SimHash fingerprints and the generalised pigeonhole principle (operator 12).

1. Every text gives one 64-bit fingerprint: bit i is set if it is set in more
   than half of the hashes of its word shingles. Equal fingerprints are one
   class from here on, however many rows have them.
2. Bits that go together are put into one part: correlations of all bits over
   all fingerprints decide, so that the parts differ as much as they can.
3. With m parts and thresholds t_1 .. t_m whose sum is d - m + 1 (-1 leaves a
   part out), two fingerprints at most d bits apart are at most t_i bits apart
   in at least one part i: else they would differ in sum(t_i + 1) = d + 1 bits.
   Each fingerprint gets the thresholds of its own that cost it least, by
   dynamic programming over candidate counts estimated from counts of the
   values of half parts.
4. A fingerprint probes the lists of all values within t_i bits of its own, and
   candidates are verified by counting differing bits.
5. A list longer than `most` is not paired. All that meet it, by index or
   probe, send themselves to every value within d / 2 bits: two of them are at
   most d bits apart exactly if they share such a value. That is linear in the
   fingerprints, whatever they have in common. Long lists are named by a bitmap
   of fixed size; one named in error is treated the same way, which is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavel.llm.tables import bitmap, components, empty, marked, stored
from gavel.llm.words import Words, fold_ascii, slices, texts_of

BITS = 64
SEED = 42
HALF_BITS = 16  # at most, of a half part: its value counts are small enough for every task
BLOCK = 1 << 17  # shingles whose bits are counted at once


@dataclass(frozen=True)
class SimParams:
    words: int = 3  # of a shingle
    distance: int = 2  # bits in which linked fingerprints may differ; even
    parts: int | None = None  # None: as many as leave a few fingerprints to a value of a part
    most: int = 64  # entries of a list that is still paired
    list_bits: int = 24  # of the bitmap of long lists

    def __post_init__(self) -> None:
        if self.distance % 2:
            raise ValueError("distance must be even")

    def count(self, rows: int) -> int:
        """How many parts; the result is the same for each number."""
        wide = max(8, int(rows).bit_length() - 3)
        return self.parts or min(8, max(2, self.distance, BITS // wide))


def _bits(values: np.ndarray) -> np.ndarray:
    """The 64 bits of every value, the lowest first."""
    return np.unpackbits(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def simhash(texts: pa.Array, n: int) -> np.ndarray:
    """Fingerprints of texts: 0 without words; with fewer than n words all of them are the one shingle."""
    words = Words(fold_ascii(texts))
    out = np.zeros(len(words.count), np.uint64)
    if not len(words):
        return out
    size = pc.binary_length(words.vocab).to_numpy(zero_copy_only=False).astype(np.int64)[words.code]
    ends = np.cumsum(size + 1) - 1
    flat = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.vocab.take(pa.array(words.code)))
    data = pc.binary_join(flat, " ")[0].as_buffer().to_pybytes()
    span = np.minimum(words.count, n)  # words of a shingle of each text
    number = np.maximum(words.count - n + 1, np.minimum(words.count, 1))  # and how many it has
    total = int(number.sum())
    start = np.repeat(words.start[:-1] - (np.cumsum(number) - number), number) + np.arange(total)
    owner = np.repeat(np.arange(len(number)), number)
    counts = np.zeros((len(number), BITS), np.int64)
    h = xxhash.xxh64_intdigest
    for a in range(0, total, BLOCK):
        at, whose = start[a : a + BLOCK], owner[a : a + BLOCK]
        left, right = (ends[at] - size[at]).tolist(), ends[at + span[whose] - 1].tolist()
        hashes = np.fromiter((h(data[x:y], SEED) for x, y in zip(left, right)), np.uint64, len(at))
        first = np.flatnonzero(np.concatenate(([True], whose[1:] != whose[:-1])))
        counts[whose[first]] += np.add.reduceat(_bits(hashes), first, axis=0, dtype=np.int64)
    return np.packbits(2 * counts > number[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, params: SimParams = SimParams()) -> DataFrame:
    """doc_id, print (the fingerprint as a signed number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4 << 20):
            found = simhash(texts_of(part), params.words).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], ["doc_id", "print"])

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print long")


@dataclass(frozen=True)
class Layout:
    """The parts: which bits of a fingerprint each of them holds, and where its two halves are cut."""

    parts: tuple[tuple[int, ...], ...]

    def value(self, prints: np.ndarray, part: int) -> np.ndarray:
        """The bits of a part, put together."""
        out = np.zeros(len(prints), np.uint64)
        for place, bit in enumerate(self.parts[part]):
            out |= (prints >> np.uint64(bit) & np.uint64(1)) << np.uint64(place)
        return out

    def halves(self, part: int) -> tuple[int, int]:
        width = len(self.parts[part])
        return width - width // 2, width // 2

    def key(self, value: np.ndarray, part: int) -> np.ndarray:
        """One number for a list: the part above its value."""
        return (value | np.uint64(part << 32)).view(np.int64)


def grouped_bits(both: np.ndarray, single: np.ndarray, rows: int, parts: int) -> Layout:
    """Parts of equal size with the most correlated bits together.

    both: in how many fingerprints two bits are set; single: each of them.
    """
    p = single / max(1, rows)
    cov = both / max(1, rows) - np.outer(p, p)
    scale = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-12))
    near = np.abs(cov / scale)
    np.fill_diagonal(near, 0)
    left, out = list(range(BITS)), []
    for part in range(parts):
        size = (BITS - sum(map(len, out))) // (parts - part)
        inner = near[np.ix_(left, left)].sum(axis=1)
        own = [left.pop(int(inner.argmax()))]
        while len(own) < size:
            own.append(left.pop(int(near[np.ix_(left, own)].sum(axis=1).argmax())))
        out.append(tuple(sorted(own)))
    return Layout(tuple(out))


def layout_of(prints: DataFrame, rows: int, params: SimParams) -> Layout:
    """Parts from the bits of all fingerprints. What reaches the driver is 64 x 64 sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            own = _bits(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)).astype(np.float64)
            both += (own.T @ own).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS)), pa.array(both.ravel())], ["cell", "n"])

    both = np.zeros(BITS * BITS, np.int64)
    for r in prints.select("print").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        both[r.cell] = r.n
    both = both.reshape(BITS, BITS)
    return grouped_bits(both, both.diagonal(), rows, params.count(rows))


def value_counts(prints: DataFrame, layout: Layout) -> list[list[np.ndarray]]:
    """For each half of each part, how many fingerprints have each value: 2^16 numbers a half at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for part in range(len(layout.parts)):
                value, (low, high) = layout.value(own, part).astype(np.int64), layout.halves(part)
                for half, x, width in ((0, value & ((1 << low) - 1), low), (1, value >> low, high)):
                    n = np.bincount(x, minlength=1 << width)
                    found = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), 2 * part + half, np.int32)), pa.array(found.astype(np.int32)), pa.array(n[found].astype(np.int64))],
                        ["half", "value", "n"],
                    )

    out = [[np.zeros(1 << width, np.int64) for width in layout.halves(part)] for part in range(len(layout.parts))]
    counts = prints.select("print").mapInArrow(run, "half int, value int, n long").groupBy("half", "value").agg(F.sum("n").alias("n"))
    for r in counts.collect():
        out[r.half // 2][r.half % 2][r.value] = r.n
    return out


def _at_distance(counts: np.ndarray, distance: int) -> list[np.ndarray]:
    """For d = 0 .. distance the counts of all values exactly d bits away."""
    width = len(counts).bit_length() - 1
    out = [counts.astype(np.float64)]
    # Adding one bit after the other: each is flipped or not.
    layers = [out[0]] + [np.zeros(len(counts)) for _ in range(distance)]
    for bit in range(width):
        flipped = np.arange(len(counts)) ^ (1 << bit)
        layers = [layers[0]] + [layers[d] + layers[d - 1][flipped] for d in range(1, distance + 1)]
    return layers


def ball(width: int, radius: int) -> np.ndarray:
    """All masks of `width` bits with at most `radius` of them set."""
    sets = (c for r in range(min(radius, width) + 1) for c in combinations(range(width), r))
    return np.array([sum(1 << b for b in c) for c in sets], np.uint64)


@dataclass(frozen=True)
class Costs:
    """Estimated candidates of a fingerprint in each part for each threshold."""

    layout: Layout
    distance: int
    rows: int
    near: tuple  # per part and half: counts at distance 0 .. distance

    @staticmethod
    def of(layout: Layout, counts: list[list[np.ndarray]], rows: int, distance: int) -> Costs:
        near = tuple(tuple(_at_distance(half, distance) for half in part) for part in counts)
        return Costs(layout, distance, rows, near)

    def estimated(self, prints: np.ndarray, part: int) -> list[np.ndarray]:
        """Candidates for thresholds 0 .. distance, halves taken as independent; each probe counts as one more."""
        value, (low, _) = self.layout.value(prints, part).astype(np.int64), self.layout.halves(part)
        a = [x[value & ((1 << low) - 1)] for x in self.near[part][0]]
        b = [x[value >> low] for x in self.near[part][1]]
        out, total = [], np.zeros(len(prints))
        for t in range(self.distance + 1):
            total = total + sum(a[x] * b[t - x] for x in range(t + 1)) / max(1, self.rows)
            out.append(total + len(ball(len(self.layout.parts[part]), t)))
        return out

    def thresholds(self, prints: np.ndarray) -> np.ndarray:
        """Per fingerprint and part the threshold (-1: not probed) of the least total cost with sum distance - parts + 1."""
        m, d = len(self.layout.parts), self.distance
        # With u = t + 1 >= 0 the sum is d + 1: best[s] is the least cost of the parts so far with sum s.
        best = np.full((d + 2, len(prints)), np.inf)
        best[0] = 0
        chosen = np.zeros((m, d + 2, len(prints)), np.int8)
        for part in range(m):
            cost = [np.zeros(len(prints)), *self.estimated(prints, part)]
            options = np.full((d + 2, d + 2, len(prints)), np.inf)
            for s in range(d + 2):
                for u in range(s + 1):
                    options[s, u] = best[s - u] + cost[u]
            chosen[part], best = options.argmin(axis=1), options.min(axis=1)
        out = np.empty((len(prints), m), np.int8)
        s = np.full(len(prints), d + 1)
        for part in reversed(range(m)):
            u = chosen[part][s, np.arange(len(prints))]
            out[:, part], s = u - 1, s - u
        return out


def _entries(prints: np.ndarray, costs: Costs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places and keys of the lists in which fingerprints stand, and of those that they probe."""
    layout, allowed = costs.layout, costs.thresholds(prints)
    index, probe = ([], []), ([], [])
    for part, bits in enumerate(layout.parts):
        value = layout.value(prints, part)
        index[0].append(np.arange(len(prints)))
        index[1].append(layout.key(value, part))
        for t in range(costs.distance + 1):
            at = np.flatnonzero(allowed[:, part] == t)
            masks = ball(len(bits), t)
            probe[0].append(np.repeat(at, len(masks)))
            probe[1].append(layout.key((value[at, None] ^ masks).ravel(), part))
    return tuple(np.concatenate(x) for x in (*index, *probe))


def _long(flags: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    """Which lists are marked as long: by the same hash as the bitmap's, of each distinct key."""
    distinct, back = np.unique(keys, return_inverse=True)
    h = xxhash.xxh64_intdigest
    data = distinct.astype("<i8").tobytes()
    place = np.fromiter((h(data[i : i + 8], SEED) for i in range(0, len(data), 8)), np.uint64, len(distinct))
    return marked(flags, (place & np.uint64((1 << bits) - 1)).astype(np.int64))[back]


def linked(prints: DataFrame, params: SimParams = SimParams()) -> DataFrame | None:
    """a, b: enough links of the distinct fingerprints `prints` (print) to connect all that are near; None without any."""
    rows = prints.count()
    layout = layout_of(prints, rows, params)
    if any(max(layout.halves(i)) > HALF_BITS for i in range(len(layout.parts))):
        raise ValueError("a part has more than 32 bits: take more parts")
    costs = Costs.of(layout, value_counts(prints, layout), rows, params.distance)

    def batch_of(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(prints.view(np.int64))], ["key", "print"])

    def index_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _pieces(batches):
            for part in range(len(layout.parts)):
                yield batch_of(layout.key(layout.value(own, part), part), own)

    kinds = "key long, print long"
    index = stored(prints.select("print").mapInArrow(index_of, kinds), "lists")
    flags = bitmap(index.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > params.most).select("key"), params.list_bits)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _pieces(batches):
            _, _, at, key = _entries(own, costs)
            short = ~_long(flags, params.list_bits, key)
            yield batch_of(key[short], own[at[short]])

    def short_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = ~_long(flags, params.list_bits, batch.column("key").to_numpy(zero_copy_only=False))
            yield batch.filter(pa.array(keep))

    around = ball(BITS, params.distance // 2)

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _pieces(batches):
            at, key, probe_at, probe_key = _entries(own, costs)
            which = np.unique(np.concatenate(
                [at[_long(flags, params.list_bits, key)], probe_at[_long(flags, params.list_bits, probe_key)]]
            ))
            yield batch_of((own[which, None] ^ around).ravel(), np.repeat(own[which], len(around)))

    probed = stored(prints.select("print").mapInArrow(probes, kinds), "probes")
    met = index.mapInArrow(short_lists, kinds).select("key", F.col("print").alias("other")).join(probed, "key")
    near = F.bit_count(F.col("print").bitwiseXOR(F.col("other"))) <= params.distance
    pairs = met.where((F.col("print") < F.col("other")) & near).select(F.col("print").alias("a"), F.col("other").alias("b"))
    # At most one member for each value within reach, so these groups are bounded.
    groups = prints.select("print").mapInArrow(stars, kinds).groupBy("key").agg(F.sort_array(F.collect_set("print")).alias("all"))
    spokes = groups.where(F.size("all") > 1).select(F.col("all")[0].alias("a"), F.explode(F.slice("all", 2, len(around))).alias("b"))
    found = stored(pairs.union(spokes).distinct(), "near")
    return None if empty(found) else found


def _pieces(batches: Iterator[pa.RecordBatch], most: int = 1 << 14) -> Iterator[np.ndarray]:
    for batch in batches:
        own = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
        for a in range(0, len(own), most):
            yield own[a : a + most]


def near_duplicates(docs: DataFrame, params: SimParams = SimParams()) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of `docs` (doc_id, text).

    component_id is the smallest doc_id reachable over links. A null text is
    empty; texts without words have the fingerprint zero and are linked like
    any other. Rows may repeat a doc_id; a row without one gets the smallest of
    its component, or null if that has none. Other columns, whatever their
    names, are left out. An empty table gives an empty result.
    """
    rows = stored(fingerprints(docs, params), "prints")
    classes = stored(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "classes")
    named = classes.select("print", F.col("first").alias("component_id"))
    if not empty(classes) and (links := linked(classes.select("print"), params)) is not None:
        met = components(links).withColumnRenamed("node", "print").join(classes, "print")
        least = met.groupBy("label").agg(F.min("first").alias("least"))
        named = named.join(met.join(least, "label").select("print", "least"), "print", "left").select(
            "print", F.coalesce("least", "component_id").alias("component_id")
        )
    # A table of its own, so that adaptive execution can split a fingerprint that very many rows have.
    out = rows.join(stored(named, "components"), "print")
    return out.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
