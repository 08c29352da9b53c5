"""Quality rules by repetition coverage (operator 8).

Rolling hashes of several n-gram lengths, in numpy, find the n-grams that occur
again in their own text; the characters inside the repeats, and inside repeated
lines, are measured as a share of the text's characters. A text whose share is
too high fails, as does one that is too short or repeats 8-word windows.

Work is map-only: a text is judged from itself alone. Hash windows are 64-bit
and compared within one text only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavel.llm.words import Words, inside, mixed, per_text, rolling, slices, texts_of, tidied

# The largest share of a text's word characters that may lie in
# repeated n-grams, by n, and in repeated lines.
NGRAM_SHARE = {5: 0.20, 6: 0.19, 7: 0.18, 8: 0.17, 9: 0.16, 10: 0.15}
LINE_SHARE = 0.20
MIN_WORDS = 20
BASE_WINDOW = 8
BASE_PERCENT = 30

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "dup_line_share double, dup_ngram_share double, kept boolean"
)
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def _covered(places: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which words lie in a window of n words that begins at one of the places."""
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + n, -1)
    return np.cumsum(edge[:-1]) > 0


def _repeats(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key occurs twice or more, and those of them that are not the first."""
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return at[:0], at[:0]
    twice = np.unique(twice)
    hit = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    again = twice[hit] == key
    places, which = at[again], hit[again]
    order = np.argsort(which, kind="stable")
    later = np.ones(len(order), bool)
    later[0] = False
    later[1:] = which[order][1:] == which[order][:-1]
    return places, np.sort(places[order[later]])


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that are equal to an earlier one, and their characters, by text."""
    split = pc.split_pattern(texts, "\n")
    coded = split.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    chars = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    keep = real[code]
    doc, code = doc[keep], code[keep]
    order = np.lexsort((code, doc))
    doc, code = doc[order], code[order]
    again = np.zeros(len(doc), bool)
    again[1:] = (doc[1:] == doc[:-1]) & (code[1:] == code[:-1])
    n = len(texts)
    return (
        np.bincount(doc[again], minlength=n),
        np.bincount(doc[again], weights=chars[code[again]], minlength=n).astype(np.int64),
    )


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """The columns of SCHEMA for a slice of texts (no nulls)."""
    words = Words(texts)
    total, start, doc = len(words), words.start, words.doc
    size = pc.utf8_length(words.vocab).to_numpy(zero_copy_only=False)
    chars = size[words.code].astype(np.int64) if total else np.zeros(0, np.int64)
    word_chars = per_text(chars, start)
    # Distinct codes spread to 64 bits, so equal words have equal values in the slice.
    value = mixed(words.code.astype(np.uint64) + np.uint64(1))
    own = mixed(doc.astype(np.uint64) + np.uint64(1 << 40))

    def windows(n: int, at: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        h, ok = rolling(value, n), inside(start, n, total)
        at = np.flatnonzero(ok) if at is None else at[(at < len(ok))][ok[at[at < len(ok)]]]
        with np.errstate(over="ignore"):
            return h[at] + own[at], at

    failed = np.zeros(len(texts), bool)
    worst = np.zeros(len(texts))
    repeat_words = np.zeros(len(texts), np.int64)
    at = None
    for n, share in NGRAM_SHARE.items():
        # An n-gram can only occur again where the (n-1)-gram does.
        places, later = _repeats(*windows(n, at))
        at = np.sort(places)
        part = per_text(chars * _covered(later, n, total), start) / np.maximum(word_chars, 1)
        failed |= part > share
        worst = np.maximum(worst, part)
        if n == BASE_WINDOW:
            repeat_words = per_text(_covered(places, n, total), start)
    dup_lines, dup_chars = _lines(texts)
    all_chars = np.maximum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), 1)
    line_share = dup_chars / all_chars
    failed |= line_share > LINE_SHARE
    base = (words.count < MIN_WORDS) | (100 * repeat_words > BASE_PERCENT * words.count)
    symbols = pc.count_substring_regex(texts, "[#*$%&|<>]").to_numpy(zero_copy_only=False).astype(np.int64)
    return dict(
        n_words=words.count, word_chars=word_chars, n_symbols=symbols, n_dup_lines=dup_lines, n_repeat_words=repeat_words,
        base_failed=base, dup_line_share=line_share, dup_ngram_share=worst, kept=~(base | failed),
    )


def repetition(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row of `docs` with the measures of SCHEMA and the verdict `kept`.

    `keep` names the columns to carry (all by default); a column of `docs` with
    the name of a measure is replaced. Null and empty texts have no words and
    fail as too short; repeated rows are judged one by one; an empty table
    gives an empty result.
    """
    carried = [c for c in (keep or docs.columns) if c not in COLUMNS]
    rows = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text}`").alias("__text"))
    kinds = T.StructType([rows.schema[c] for c in carried] + list(T._parse_datatype_string(SCHEMA)))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column="__text"):
            found = measures(texts_of(part, "__text"))
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in carried] + [pa.array(found[c]) for c in COLUMNS], carried + COLUMNS
            )

    return rows.mapInArrow(run, kinds)
