"""Collocations from a prefix-free parse (operator 11).

1. Texts are cut where their content says so: wherever the hash of `longest - 1`
   tokens in a row is a multiple of `modulus`. A chunk runs from one such
   trigger to the end of the next, so neighbours overlap by a trigger, and equal
   passages give equal chunks wherever they stand. Distinct chunks with their
   frequencies are the dictionary: a passage of a thousand copies is looked at
   once from here on.
2. Phrases are counted inside distinct chunks, weighted by the frequency. A
   phrase counts for the chunk in which it starts before the closing trigger,
   so the overlap is counted once, and up to `longest` words fit.
3. Lengths are counted one after the other. A phrase of n words occurs at most
   as often as either phrase of n - 1 words in it, so only phrases whose parts
   reached `least` are counted. Which did is a bitmap of fixed size: what it
   lets through in error is counted and then dropped by its count.
4. Scores, cuts and containment are joins between the frequent phrases, which
   number at most the words divided by `least`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gavel.llm.ragged import gathered
from gavel.llm.tables import bitmap, marked, stored
from gavel.llm.words import Words, mixed, rolling, slices

UNKNOWN = "und"  # language of rows without one
BREAK = "."  # stands for every character that ends a piece; never part of a word
TOTAL = ""  # key of the word count of a language; never a word
SEED = 42


@dataclass(frozen=True)
class PhraseParams:
    longest: int = 4  # words of a phrase
    least: int = 30  # occurrences of a candidate
    modulus: int = 16  # mean words between triggers
    inside_percent: int = 80  # a candidate goes if a longer one around it occurs at least as often as this share
    top: int = 2000  # phrases of the report per language
    scale: int = 2_000_000
    bits: int = 24  # of the bitmaps of frequent phrases
    spread: int = 32  # parts in which a language's candidates are ranked before the final ranking
    slice_bytes: int = 4 << 20


def _table() -> np.ndarray:
    """Bytes after folding: A-Z to lower case, piece ends to BREAK."""
    out = np.arange(256, dtype=np.uint8)
    out[ord("A") : ord("Z") + 1] += 32
    for c in b".,;:!?\n\x0b\x0c\r":
        out[c] = ord(BREAK)
    return out


FOLD = _table()


def tokens(texts: pa.Array) -> Words:
    """Words and piece ends of every text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, ends, data = texts.buffers()
    folded = FOLD[np.frombuffer(data, np.uint8)] if data is not None else np.empty(0, np.uint8)
    texts = pa.Array.from_buffers(pa.large_string(), len(texts), [None, ends, pa.py_buffer(folded)], 0, texts.offset)
    return Words(pc.replace_substring(texts, BREAK, f" {BREAK} ").cast(pa.large_string()))


def _joined(codes: np.ndarray, length: np.ndarray, vocab: pa.Array) -> pa.Array:
    """Texts of `length` tokens each, joined by a space."""
    ends = pa.array(np.concatenate(([0], np.cumsum(length))).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(ends, vocab.cast(pa.string()).take(pa.array(codes))), " ")


def chunks(docs: DataFrame, params: PhraseParams = PhraseParams()) -> DataFrame:
    """lang, chunk, core, freq: the distinct chunks, the tokens at which a phrase may start, and how often each occurs."""
    overlap = params.longest - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, params.slice_bytes):
            words = tokens(part.column("text"))
            total, start = len(words), words.start
            if not total:
                continue
            found = mixed(rolling(words.hashes(), overlap)) % np.uint64(params.modulus) == 0 if overlap else np.ones(total, bool)
            begins = np.zeros(total + 1, bool)
            begins[: len(found)] = found
            for back in range(1, overlap):  # a trigger may not run over the end of its text
                at = start[1:] - back
                begins[at[at >= 0]] = False
            begins[start[:-1][words.count > 0]] = True
            begins[total] = False
            first = np.flatnonzero(begins)
            core = np.diff(np.append(first, total))
            doc = np.searchsorted(start, first, "right") - 1
            length = np.minimum(core + overlap, start[doc + 1] - first)
            yield pa.RecordBatch.from_arrays(
                [part.column("lang").take(pa.array(doc)),
                 _joined(gathered(words.code, first, length), length, words.vocab), pa.array(core.astype(np.int32))],
                ["lang", "chunk", "core"],
            )

    langs = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    found = docs.select("text", langs).mapInArrow(run, "lang string, chunk string, core int")
    return found.groupBy("lang", "chunk", "core").agg(F.count("*").alias("freq"))


def _merged(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Small batches joined to about `budget` bytes: more repeats meet in one."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= budget:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held and (rest := pa.Table.from_batches(held).combine_chunks().to_batches()):
        yield rest[0]


def _summed(kind: np.ndarray, weights: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below `kinds` that occur, and the whole sums of their weights."""
    total = np.zeros(kinds, np.int64)
    np.add.at(total, kind, weights)
    found = np.flatnonzero(total)
    return found, total[found]


def _hashes(words: np.ndarray, langs: np.ndarray, n: int, at: np.ndarray) -> np.ndarray:
    """Hashes of the phrases of n words at the places `at`, from those of words and of their text's language."""
    return mixed(rolling(words, n)[at] + langs[at]) if len(at) else np.empty(0, np.uint64)


def _name_hashes(names: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(x.encode(), SEED) for x in names.to_pylist()), np.uint64, len(names))


def _flags(found: DataFrame, order: int, bits: int) -> np.ndarray:
    """A bitmap of frequent phrases of `order` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column("lang").cast(pa.string()).dictionary_encode()
            langs = _name_hashes(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)] if batch.num_rows else np.empty(0, np.uint64)
            words = Words(batch.column("phrase"))
            own = _hashes(words.hashes(), langs[words.doc], order, words.start[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64))], ["hash"])

    return bitmap(found.where(F.col("phrase") != TOTAL).select("lang", "phrase").mapInArrow(run, "hash long"), bits, hashed=False)


def phrase_counts(dictionary: DataFrame, order: int, filters: list[np.ndarray], params: PhraseParams = PhraseParams()) -> DataFrame:
    """lang, phrase, f of the phrases of `order` words whose parts are marked in `filters` (one for each shorter length).

    With order 1 there is a row of TOTAL for each language, the count of its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _merged(batches, params.slice_bytes):
            words = Words(batch.column("chunk"))
            coded = batch.column("lang").cast(pa.string()).dictionary_encode()
            lang, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
            kinds = max(1, len(words.vocab))
            doc, code = words.doc, words.code.astype(np.int64)
            freq = batch.column("freq").to_numpy(zero_copy_only=False)[doc]
            inside = np.arange(len(code)) - words.start[doc] < batch.column("core").to_numpy(zero_copy_only=False)[doc]
            at = np.flatnonzero(pc.not_equal(words.vocab, BREAK).to_numpy(zero_copy_only=False)[code]) if len(code) else code
            if order == 1:
                own = at[inside[at]]
                which, n = _summed(lang[doc[own]], freq[own], len(names))
                yield _counted(names.take(pa.array(which)), pa.array([TOTAL] * len(which)), n)
            elif len(code):
                langs, hashes = _name_hashes(names)[lang][doc], words.hashes()
                for n in range(1, order):
                    place = _hashes(hashes, langs, n, at) & np.uint64((1 << params.bits) - 1)
                    at = at[marked(filters[n - 1], place.astype(np.int64))]
                    follows = np.zeros(len(code) + 1, bool)
                    follows[at] = True
                    at = at[follows[at + 1] & (doc[at] == doc[np.minimum(at + 1, len(code) - 1)])]
            # kind: a number for each distinct (language, phrase) at the places `at`, with its language and text.
            kind, distinct = pd.factorize(lang[doc[at]] * kinds + code[at])
            langs, texts = distinct // kinds, words.vocab.take(pa.array(distinct % kinds))
            for n in range(1, order):
                kind, distinct = pd.factorize(kind * kinds + code[at + n])
                head = distinct // kinds
                texts = pc.binary_join_element_wise(texts.take(pa.array(head)), words.vocab.take(pa.array(distinct % kinds)), " ")
                langs = langs[head]
            own = inside[at]
            which, n = _summed(kind[own], freq[at[own]], len(langs))
            yield _counted(names.take(pa.array(langs[which])), texts.take(pa.array(which)), n)

    found = dictionary.mapInArrow(run, "lang string, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= params.least) | (F.col("phrase") == TOTAL))


def _counted(langs: pa.Array, texts: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([langs, texts, pa.array(n.astype(np.int64))], ["lang", "phrase", "f"])


def frequent_phrases(docs: DataFrame, params: PhraseParams = PhraseParams()) -> list[DataFrame]:
    """Per length the phrases that reach `least`, as stored tables; the first also has the TOTAL rows."""
    dictionary = stored(chunks(docs, params), "chunks")
    filters: list[np.ndarray] = []
    out = []
    for order in range(1, params.longest + 1):
        found = stored(phrase_counts(dictionary, order, filters, params), f"phrases-{order}")
        if order < params.longest:
            filters.append(_flags(found, order, params.bits))
        out.append(found)
    return out


def _wide(x: Column) -> Column:
    """Products of counts can pass 64 bits."""
    return x.cast("decimal(25,0)")


def collocations(docs: DataFrame, params: PhraseParams = PhraseParams()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to `longest` words of `docs` (text, lang).

    A null text has no words; a null language counts as UNKNOWN, like rows
    that name it. Rows are counted as they are, repeated ones too. Other
    columns, whatever their names, are left out. A language without candidates
    gives no rows, an empty table none at all.
    """
    found = frequent_phrases(docs.select("text", "lang"), params)
    words = found[0].where(F.col("phrase") != TOTAL)
    size = found[0].where(F.col("phrase") == TOTAL).select("lang", F.col("f").alias("n"))
    candidates, known = None, words
    for longer in found[1:]:
        candidates = longer if candidates is None else candidates.union(longer)
        known = known.union(longer)
    candidates = candidates.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    join = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    count = F.size("words")

    # All cuts, with the counts of their parts: parts of a candidate are frequent, too.
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), count - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", join(F.lit(1), F.col("k")).alias("left"), join(F.col("k") + 1, count - F.col("k")).alias("right")
    )
    part = lambda name, f: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = stored(cuts.join(part("left", "l"), ["lang", "left"]), "cuts").join(part("right", "r"), ["lang", "right"])
    score = F.expr(f"({params.scale}BD * cast(a AS decimal(25,0))) div (cast(l AS decimal(25,0)) + cast(r AS decimal(25,0)))")
    lowest = cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    lowest = lowest.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut"))

    # The most frequent longer candidate around each shorter one decides.
    within = candidates.where(count > 2).select(
        "lang", "a", "words", F.explode(F.sequence(F.lit(2), count - 1)).alias("length")
    ).select("lang", "a", "words", "length", F.explode(F.sequence(F.lit(1), count - F.col("length") + 1)).alias("at"))
    around = within.select("lang", join(F.col("at"), F.col("length")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = lowest.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * _wide(F.col("longer")) < params.inside_percent * _wide(F.col("a")))
    ).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part_of = F.pmod(F.xxhash64("phrase"), F.lit(params.spread))
    best = kept.withColumn("part", part_of).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = best.where(F.col("rank") <= params.top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= params.top)
    return best.join(size, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
