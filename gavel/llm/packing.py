"""Packing by lexical retrieval (operator 3).

Documents become token ids; whole windows of a document that is longer than a
window are sequences of their own. What is left of the documents of a shard is
indexed by BM25 over words. The largest rest is the seed of a window; its
rarest words query the index, and the unused neighbours, best first, fill the
window. The last one is cut to fit, and its rest stays in the index. Only the
end of a shard has no full window left: it is cut into powers of two.

A shard is a run of documents of one partition, bounded by bytes, so packing is
map-only: no ids are shuffled, no group can grow, and a lost task packs its own
documents again in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from gavel.llm.words import Words, slices, texts_of, tidied
from gavel.llm.wordtokens import word_tokens

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
COLUMNS = [c.split()[0] for c in PIECES.split(", ")]


@dataclass(frozen=True)
class PackParams:
    file: str  # the vocabulary
    window: int = 2048
    end: int = 1
    query_words: int = 16  # words of a seed that search
    k1: float = 1.2
    b: float = 0.75
    shard_bytes: int = 16 << 20


class _Index:
    """BM25 weights by word, for the documents of a shard that have a rest."""

    def __init__(self, words: Words, params: PackParams) -> None:
        docs, vocab = len(words.count), max(1, len(words.vocab))
        key = np.sort(words.doc * vocab + words.code)
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else key
        tf = np.diff(np.append(first, len(key)))
        doc, word = key[first] // vocab, key[first] % vocab
        df = np.bincount(word, minlength=vocab)
        idf = np.log1p((docs - df + 0.5) / (df + 0.5))
        useful = df[word] > 1  # a word of one document finds nothing else
        doc, word, tf = doc[useful], word[useful], tf[useful]
        size = words.count / max(1.0, words.count.mean()) if docs else words.count
        weight = idf[word] * tf * (params.k1 + 1) / (tf + params.k1 * (1 - params.b + params.b * size[doc]))
        # By document the words, rarest first; by word the documents.
        order = np.lexsort((df[word], doc))
        self.by_doc = word[order]
        self.doc_at = np.searchsorted(doc[order], np.arange(docs + 1))
        order = np.argsort(word, kind="stable")
        self.found, self.weight = doc[order], weight[order].astype(np.float32)
        self.word_at = np.searchsorted(word[order], np.arange(vocab + 1))
        self.query_words = params.query_words

    def neighbours(self, seed: int) -> np.ndarray:
        """Other documents by falling score (ties: smaller place first)."""
        query = self.by_doc[self.doc_at[seed] : self.doc_at[seed + 1]][: self.query_words]
        spans = [slice(self.word_at[w], self.word_at[w + 1]) for w in query]
        if not spans:
            return query
        found = np.concatenate([self.found[s] for s in spans])
        score = np.bincount(found, weights=np.concatenate([self.weight[s] for s in spans]))
        docs = np.unique(found)
        docs = docs[docs != seed]
        return docs[np.argsort(-score[docs], kind="stable")]


def packed_shard(size: np.ndarray, words: Words, params: PackParams) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) for documents of the given token counts."""
    window = params.window
    for doc in np.flatnonzero(size >= window):
        for k in range(size[doc] // window):
            yield [(int(doc), k * window, window)]
    start = size // window * window
    rest = size - start
    index = _Index(words, params)
    order = np.argsort(-rest, kind="stable")
    order = order[rest[order] > 0].tolist()
    start, left = start.tolist(), rest.tolist()
    todo = int(rest.sum())
    fill = 0  # the next document of `order` that may still be unused

    def unused(seed: int) -> Iterator[int]:
        for doc in index.neighbours(seed).tolist():
            if left[doc]:
                yield doc
        for at in range(fill, len(order)):  # no neighbour is left: the next largest rests
            if left[order[at]]:
                yield order[at]

    def taken(doc: int, room: int) -> tuple[int, int, int]:
        n = min(left[doc], room)
        piece = (doc, start[doc], n)
        start[doc] += n
        left[doc] -= n
        return piece

    while todo >= window:
        while not left[order[fill]]:
            fill += 1
        seed = order[fill]
        pieces = [taken(seed, window)]
        room = window - pieces[0][2]
        if room:
            for doc in unused(seed):
                pieces.append(taken(doc, room))
                room -= pieces[-1][2]
                if not room:
                    break
        todo -= window
        yield pieces
    pieces, room = [], 0
    for doc in order[fill:]:
        while left[doc]:
            if not room:
                if pieces:
                    yield pieces
                pieces, room = [], 1 << (todo.bit_length() - 1)
                todo -= room
            pieces.append(taken(doc, room))
            room -= pieces[-1][2]
    if pieces:
        yield pieces


def packed(docs: DataFrame, params: PackParams) -> DataFrame:
    """PIECES of all `docs` (doc_id, text): every id of every document lies in exactly one piece.

    ids are the piece's ids as little-endian 32-bit integers. A null text is
    empty and gives the end id alone; repeated rows and rows without doc_id
    are packed like any other; an empty table gives an empty result.
    """

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(params.file)
        task = TaskContext.get()
        sequence = (task.partitionId() if task else 0) << 32
        for shard in slices(batches, params.shard_bytes):
            ids, bounds, words = tokens.encode(texts_of(shard), params.end)
            raw = ids.astype("<u4")
            size = np.diff(bounds)
            rows: list[tuple] = []
            blobs: list[bytes] = []
            for pieces in packed_shard(size, words, params):
                offset = 0
                for doc, at, n in pieces:
                    rows.append((doc, at, n, sequence, offset))
                    a = bounds[doc] + at
                    blobs.append(raw[a : a + n].tobytes())
                    offset += n
                sequence += 1
            table = np.array(rows, np.int64).reshape(-1, 5)
            doc = table[:, 0]
            yield pa.RecordBatch.from_arrays(
                [shard.column("doc_id").take(pa.array(doc)), pa.array(table[:, 1]), pa.array(table[:, 2]), pa.array(blobs, pa.binary()),
                 pa.array(size[doc]), pa.array(table[:, 3]), pa.array(table[:, 4])],
                COLUMNS,
            )
        tokens.forget()

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)
