"""Scores of an n-gram language model in Elias-Fano tries (operator 1).

The model is an interpolated bigram model with absolute discounting over the
add-half unigrams of `base_score`:

    p(w | v) = max(c(v w) - D, 0) / c(v) + D * kinds(v) / c(v) * p(w)

Neither the counts nor the model have a bound, so nothing of them is broadcast:
texts ask, shards of the model answer.

1. A pass over the texts stores slices: each text's words as places in the
   slice's vocabulary. Words are 64-bit hashes.
2. Slices send their vocabulary with training counts to word shards, which add
   up and answer with the totals.
3. Slices send their distinct bigrams, with training counts, to context shards.
   A shard builds its part of the trie: sorted contexts, monotone pointers to
   their successors, successors relative to their context as one Elias-Fano
   sequence, and the discounted probabilities on 255 logarithmic levels. The
   trie is written to an unlinked file, mapped, and asked for every slice's
   bigrams by successor search; the answers are one byte a bigram.
4. Slices meet the answers and add up the scores of their texts.

A context that holds much of all tokens is split by successor over several
shards: its parts are asked for by every slice that has the context, and answer
with their share of kinds(v). What travels is pre-aggregated by slice, so no
word or bigram, however frequent, is more than a row's few bytes in a slice.
"""

from __future__ import annotations

import mmap
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavel.llm.eliasfano import EliasFano
from gavel.llm.tables import stored
from gavel.llm.words import MIX, Words, fold_ascii, mixed, slices, texts_of

START, END = np.uint64(1), np.uint64(2)  # hashes of the text's edges; words have greater ones
SUCCESSOR_BITS = 40  # of a successor's hash in the trie: one in 10**5 words shares its own with one of 10**7 others
LEVELS, LOWEST = 255, -12.0  # steps of the quantised log10 probabilities
KEYS = ["slice", "shard", "kind", "body"]
MESSAGE = "slice long, shard int, kind int, body binary"
SLICE, WORDS, BIGRAMS = 0, 1, 2


@dataclass(frozen=True)
class NgramParams:
    discount: float = 0.75
    slice_bytes: int = 12 << 20  # text of a slice
    shard_tokens: int = 2_000_000  # training and other tokens for a shard, about
    hot_share: float = 1 / 16  # of a shard's tokens: a context with more is split


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays, one after the other, each with its kind and size."""
    out = []
    for x in arrays:
        out.append(struct.pack("<3sQ", x.dtype.str.encode(), x.nbytes))
        out.append(x.tobytes())
    return b"".join(out)


def _unpack(body) -> list[np.ndarray]:
    data, at, out = memoryview(body), 0, []
    while at < len(data):
        kind, size = struct.unpack_from("<3sQ", data, at)
        at += 11
        out.append(np.frombuffer(data[at : at + size], kind.decode()))
        at += size
    return out


def _least(x: np.ndarray) -> np.ndarray:
    """The same values in the smallest unsigned type."""
    top = int(x.max()) if len(x) else 0
    return x.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max))


def _message(slice_: int, shard: int, kind: int, body: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([slice_], pa.int64()), pa.array([shard], pa.int32()), pa.array([kind], pa.int32()), pa.array([body], pa.binary())], KEYS
    )


def _messages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes]]:
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in KEYS])


class Slice:
    """Texts of a slice as codes into its vocabulary of hashes, most frequent first."""

    def __init__(self, body: bytes) -> None:
        ids, valid, train, count, low, high, self.vocab = _unpack(body)
        self.doc_ids = pa.array(ids, mask=~valid.view(bool))
        self.train = train.view(bool)
        self.count = count.astype(np.int64)
        self.code = low.astype(np.int64) | high.astype(np.int64) << 16
        self.start = np.concatenate(([0], np.cumsum(self.count)))

    @staticmethod
    def of(batch: pa.RecordBatch) -> bytes:
        words = Words(fold_ascii(texts_of(batch)))
        h = mixed(np.maximum(words.hashes(), np.uint64(3)) ^ MIX)
        h = np.where(h <= END, h + np.uint64(3), h)
        vocab, code = np.unique(h, return_inverse=True) if len(h) else (h, np.empty(0, np.int64))
        order = np.argsort(-np.bincount(code, minlength=len(vocab)), kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        code = place[code]
        ids = batch.column("doc_id")
        return _pack(
            ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
            np.asarray(ids.is_valid().to_numpy(zero_copy_only=False), np.uint8),
            np.asarray(batch.column("train").to_numpy(zero_copy_only=False), np.uint8),
            _least(words.count), (code & 0xFFFF).astype(np.uint16), _least(code >> 16), vocab[order],
        )

    def word_counts(self) -> np.ndarray:
        """How often each word of the vocabulary is in training texts."""
        own = self.code[np.repeat(self.train, self.count)]
        return np.bincount(own, minlength=len(self.vocab))

    def tokens(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Context and token places (vocabulary, then START, END) of every token, and its text."""
        n, size = len(self.count), len(self.vocab)
        token = np.insert(self.code, self.start[1:], size + 1)
        context = np.insert(self.code, self.start[:-1], size)
        return context, token, np.repeat(np.arange(n), self.count + 1)

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, token) places, their training counts, each token's bigram, and each token's text."""
        context, token, doc = self.tokens()
        size = np.int64(len(self.vocab) + 2)
        key = context * size + token
        order = np.argsort(key)
        key = key[order]
        new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.empty(0, bool)
        which = np.empty(len(key), np.int64)
        which[order] = np.cumsum(new) - 1
        key = key[new]
        count = np.bincount(which[self.train[doc]], minlength=len(key))
        return key // size, key % size, count, which, doc


def _slices_of(docs: DataFrame, train, params: NgramParams) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for n, part in enumerate(slices(batches, params.slice_bytes)):
            yield _message((task << 32) + n, 0, SLICE, Slice.of(part))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(train, F.lit(False)).alias("train"))
    return rows.mapInArrow(run, MESSAGE)


def _asked_words(parts: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slice_, _, _, body in _messages(batches):
            own = Slice(body)
            count = own.word_counts()
            shard = (own.vocab % np.uint64(shards)).astype(np.int64)
            for s in range(shards):
                at = shard == s
                if at.any():
                    yield _message(slice_, s, WORDS, _pack(own.vocab[at], _least(count[at])))

    return parts.mapInArrow(run, MESSAGE)


def _answered_words(asked: DataFrame) -> DataFrame:
    """Answers to slices (kind WORDS) and one row of totals a shard (kind -1: tokens, distinct words, frequent words)."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = key[0].as_py()
        found = [(slice_, *_unpack(body)) for slice_, _, _, body in _messages(batches)]
        words = np.concatenate([w for _, w, _ in found])
        counts = np.concatenate([c.astype(np.int64) for _, _, c in found])
        order = np.argsort(words)
        words, counts = words[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
        total = np.add.reduceat(counts, first)
        words = words[first]
        for slice_, own, _ in found:
            yield _message(slice_, shard, WORDS, _pack(_least(total[np.searchsorted(words, own)])))
        top = np.argsort(-total, kind="stable")[:64]
        top = top[total[top] > 0]
        yield _message(0, shard, -1, _pack(np.array([total.sum(), (total > 0).sum()], np.int64), words[top], total[top]))

    return asked.groupBy("shard").applyInArrow(run, MESSAGE)


def _vocabulary_counts(own: Slice, answers: list[tuple[int, bytes]], shards: int, starts: int) -> np.ndarray:
    """Training counts of the vocabulary's words, then of START and END."""
    out = np.zeros(len(own.vocab) + 2, np.int64)
    out[-2:] = starts
    shard = (own.vocab % np.uint64(shards)).astype(np.int64)
    for s, body in answers:
        out[:-2][shard == s] = _unpack(body)[0]
    return out


@dataclass(frozen=True)
class Layout:
    """How bigrams are dealt to shards; the same for asking and for reading the answers."""

    shards: int
    hot: tuple[tuple[int, int, int], ...]  # contexts that are split (hash, number of parts, training count)

    def parts(self, contexts: np.ndarray) -> np.ndarray:
        out = np.ones(len(contexts), np.int64)
        for h, n, _ in self.hot:
            out[contexts == np.uint64(h)] = n
        return out

    def dealt(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The shard of every bigram, from the hashes."""
        part = (mixed(token ^ MIX) % self.parts(context).astype(np.uint64)).astype(np.int64)
        return ((mixed(context) % np.uint64(self.shards)).astype(np.int64) + part) % self.shards


class Questions:
    """A slice's distinct bigrams by shard: in each, contexts with their successors."""

    def __init__(self, own: Slice, layout: Layout) -> None:
        self.context, self.token, self.count, self.which, self.doc = own.bigrams()
        hashes = np.concatenate([own.vocab, [START, END]]).astype(np.uint64)
        h, t = hashes[self.context], hashes[self.token]
        shard = layout.dealt(h, t)
        # In a shard: by context hash, then by successor hash.
        successor = t & np.uint64((1 << SUCCESSOR_BITS) - 1)
        self.order = np.lexsort((successor, h, shard))
        self.successor, self.hashes = successor, h
        self.bounds = np.searchsorted(shard[self.order], np.arange(layout.shards + 1))
        # Every part of a split context is asked for its kinds, also where the slice has none of its successors.
        self.extra: dict[int, list[int]] = {}
        mine = set(own.vocab[np.isin(own.vocab, np.array([x for x, _, _ in layout.hot], np.uint64))].tolist()) | {int(START)}
        for x, n, _ in layout.hot:
            if x in mine and (x != int(START) or len(own.count)):
                first = int(mixed(np.array([x], np.uint64))[0] % np.uint64(layout.shards))
                for part in range(n):
                    self.extra.setdefault((first + part) % layout.shards, []).append(x)
        self.shards = layout.shards

    def of(self, shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Contexts asked for, number of successors of each, and the places of the shard's bigrams in order."""
        at = self.order[self.bounds[shard] : self.bounds[shard + 1]]
        context, size = np.unique(self.hashes[at], return_counts=True)
        more = np.setdiff1d(np.array(self.extra.get(shard, []), np.uint64), context)
        if len(more):
            context = np.concatenate([context, more])
            size = np.concatenate([size, np.zeros(len(more), size.dtype)])
            order = np.argsort(context)
            context, size = context[order], size[order]
        return (context, size, at) if len(context) else None


def _asked_bigrams(parts: DataFrame, layout: Layout) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slice_, _, _, body in _messages(batches):
            asked = Questions(Slice(body), layout)
            for s in range(layout.shards):
                if (mine := asked.of(s)) is not None:
                    context, size, at = mine
                    successor = asked.successor[at]
                    low, high = successor.astype(np.uint32), (successor >> np.uint64(32)).astype(np.uint8)
                    yield _message(slice_, s, BIGRAMS, _pack(context, _least(size), low, high, _least(asked.count[at])))

    return parts.mapInArrow(run, MESSAGE)


class Trie:
    """Two levels, contexts and their successors, in one mapped buffer."""

    HEAD = struct.Struct("<Q")

    @classmethod
    def written(cls, context: np.ndarray, successor: np.ndarray, probability: np.ndarray) -> bytes:
        """Of bigrams in order of (context, successor)."""
        contexts, first = np.unique(context, return_index=True)
        words = np.unique(successor)
        local = np.searchsorted(words, successor).astype(np.uint64)
        pointer = np.append(first, len(context)).astype(np.uint64)
        # Relative to their context: each range starts above all of the range before.
        rank = np.repeat(np.arange(len(contexts), dtype=np.uint64), np.diff(pointer.astype(np.int64)))
        levels = [EliasFano.of(x).write() for x in (contexts, words, pointer, rank * np.uint64(max(1, len(words))) + local)]
        step = LOWEST / LEVELS
        codes = np.clip(np.round(np.log10(np.maximum(probability, 1e-300)) / step), 0, LEVELS - 1).astype(np.uint8) + np.uint8(1)
        return b"".join(cls.HEAD.pack(len(x)) + x for x in levels) + codes.tobytes()

    def __init__(self, data: bytes) -> None:
        with tempfile.TemporaryFile() as file:  # unlinked from the start: nothing stays on the executor
            file.write(data)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        raw, at, levels = np.frombuffer(self.map, np.uint8), 0, []
        for _ in range(4):
            at += self.HEAD.size
            level, at = EliasFano.read(raw, at)
            levels.append(level)
        self.contexts, self.words, self.pointers, self.successors = levels
        self.codes = raw[at:]
        self.plain_words = self.words.at(np.arange(self.words.n))  # looked up as often as the trie itself

    def find(self, context: np.ndarray, size: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Successors in the trie of each context, and a code for each bigram (0: not there)."""
        place, known = self.contexts.successor(context)
        kinds = np.zeros(len(context), np.int64)
        start = np.zeros(len(context), np.int64)
        if known.any():
            start[known] = self.pointers.at(place[known])
            kinds[known] = self.pointers.at(place[known] + 1).astype(np.int64) - start[known]
        code = np.zeros(len(successor), np.uint8)
        owner = np.repeat(np.arange(len(context)), size)
        local = np.searchsorted(self.plain_words, successor)
        ask = known[owner] & (local < len(self.plain_words))
        ask[ask] = self.plain_words[local[ask]] == successor[ask]
        if ask.any():
            value = place[owner[ask]].astype(np.uint64) * np.uint64(max(1, self.words.n)) + local[ask].astype(np.uint64)
            at, found = self.successors.successor(value)
            code[np.flatnonzero(ask)[found]] = self.codes[at[found]]
        return kinds, code


def _answered_bigrams(asked: DataFrame, layout: Layout, params: NgramParams) -> DataFrame:
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = key[0].as_py()
        questions = []
        for slice_, _, _, body in _messages(batches):
            context, size, low, high, count = _unpack(body)
            questions.append((slice_, context, size.astype(np.int64), low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32), count))
        contexts = np.unique(np.concatenate([q[1] for q in questions]))
        keys, counts = [], []
        for _, context, size, successor, count in questions:
            at = np.searchsorted(contexts, context)
            trained = count > 0
            keys.append((np.repeat(at, size).astype(np.uint64) << np.uint64(SUCCESSOR_BITS) | successor)[trained])
            counts.append(count[trained].astype(np.int64))
        key, count = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key)
        key, count = key[order], count[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
        count = np.add.reduceat(count, first) if len(key) else count
        key = key[first]
        rank = (key >> np.uint64(SUCCESSOR_BITS)).astype(np.int64)
        # A context is followed by a token each time it occurs; a split one has its count in the layout.
        total = np.bincount(rank, weights=count, minlength=len(contexts))
        for x, _, n in layout.hot:
            total[contexts == np.uint64(x)] = n
        probability = (count - params.discount) / np.maximum(total[rank], 1)
        trie = Trie(Trie.written(contexts[rank], key & np.uint64((1 << SUCCESSOR_BITS) - 1), probability))
        for slice_, context, size, successor, _ in questions:
            kinds, code = trie.find(context, size, successor)
            yield _message(slice_, shard, BIGRAMS, _pack(_least(kinds), code))

    return asked.groupBy("shard").applyInArrow(run, MESSAGE)


SCORES = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"


def scored(docs: DataFrame, train, params: NgramParams = NgramParams()) -> DataFrame:
    """SCORES and train_tokens of every row of `docs` (doc_id, text); rows where `train` holds teach the model.

    Scores are log10 probabilities of the text's words, A-Z lower-cased, and
    one end. A null or empty text has the end alone. Rows without doc_id are
    scored (`train` of a null is false); repeated rows are scored, and teach,
    one by one. An empty table gives an empty result; without training rows
    every token has the same probability.
    """
    parts = stored(_slices_of(docs, train, params), "slices")
    sizes = parts.agg(F.sum(F.length("body"))).first()[0] or 0
    starts = docs.where(train).count()
    # A word takes about three bytes of a slice.
    shards = max(4, int(-(-(sizes // 3) // params.shard_tokens)))
    answers = stored(_answered_words(_asked_words(parts, shards)), "words")
    tokens, kinds, hot = starts, 1 if starts else 0, []
    for row in answers.where("kind = -1").toLocalIterator():  # a row a shard
        sums, words, counts = _unpack(row.body)
        tokens += int(sums[0])
        kinds += int(sums[1])
        hot += list(zip(words.tolist(), counts.tolist()))
    # At most 1/limit contexts can be hot, whatever the corpus.
    limit = max(1.0, tokens / shards * params.hot_share)
    hot = [(w, min(shards, int(c / limit) + 1), c) for w, c in [*hot, (int(START), starts)] if c > limit]
    layout = Layout(shards, tuple(sorted(hot)))
    totals = answers.where("kind >= 0")
    bigrams = stored(_answered_bigrams(_asked_bigrams(parts, layout), layout, params), "bigrams")
    rest = tokens + 0.5 * (kinds + 1)

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(_messages(batches))
        own = Slice(next(b for _, _, k, b in found if k == SLICE))
        counts = _vocabulary_counts(own, [(s, b) for _, s, k, b in found if k == WORDS], shards, starts)
        answered = {s: _unpack(b) for _, s, k, b in found if k == BIGRAMS}
        asked = Questions(own, layout)
        code = np.zeros(len(asked.context), np.uint8)
        hashes = np.concatenate([own.vocab, [START, END]]).astype(np.uint64)
        order = np.argsort(hashes)
        followers = np.zeros(len(hashes), np.int64)
        for s in range(shards):
            if (mine := asked.of(s)) is None:
                continue
            context, _, at = mine
            kinds_of, codes = answered[s]
            np.add.at(followers, order[np.searchsorted(hashes[order], context)], kinds_of.astype(np.int64))
            code[at] = codes
        base = np.log10((counts + 0.5) / rest) if rest > 0 else np.zeros(len(counts))
        seen = np.maximum(counts[asked.context], 1)
        weight = np.where(counts[asked.context] > 0, params.discount * followers[asked.context] / seen, 1.0)
        own_part = np.where(code > 0, 10.0 ** ((code.astype(np.float64) - 1) * (LOWEST / LEVELS)), 0.0)
        p = np.log10(own_part + weight * 10.0 ** base[asked.token])
        doc, n = asked.doc, len(own.count)
        token = asked.token[asked.which]
        yield pa.RecordBatch.from_arrays(
            [own.doc_ids, pa.array(own.train), pa.array(own.count + 1),
             pa.array(np.bincount(doc, weights=counts[token] > 0, minlength=n).astype(np.int64)),
             pa.array(np.bincount(doc, weights=base[token], minlength=n)), pa.array(np.bincount(doc, weights=p[asked.which], minlength=n))],
            [c.split()[0] for c in SCORES.split(", ")],
        )

    return parts.union(totals).union(bigrams).groupBy("slice").applyInArrow(run, SCORES).withColumn("train_tokens", F.lit(tokens).cast("long"))
