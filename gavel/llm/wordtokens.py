"""Token ids of whole texts by the tokenizers library, one distinct word at a time.

The vocabulary's tokenizer drops white space and never joins across it, so a
text's ids are those of its words in order (markers such as an end of text that
a text spells out become their own ids, as in the library). Each distinct word of a slice is
encoded once. Words of Latin letters, with or without punctuation behind, are
encoded as their two parts: the letters, already lower-cased, need no
normaliser and no splitting pattern, and many words share them.
"""

from __future__ import annotations

import os
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gavel.llm.ragged import RunCache, gathered
from gavel.llm.words import Words

# Letters whose lower case is one letter of the same kind and which no normaliser changes.
LETTERS = "a-zA-ZÀ-ÖØ-öø-ÿ"
JOINED = 2000  # words given to the library at once


class WordTokens:
    def __init__(self, file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallel unit
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.full = Tokenizer.from_file(file)
        self.letters = Tokenizer.from_file(file)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocab = self.full.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.last[i] = token.endswith("</w>")
        self.words = RunCache(self._encode)
        self.marks = RunCache(self._one_by_one)

    def forget(self) -> None:
        """Drop the runs of all words: most are those of few texts, and the worker outlives its task."""
        self.words.clear()
        self.marks.clear()

    def _one_by_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.full.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.int32, int(sizes.sum())), sizes

    def _encode_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        blocks = [" ".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        ids = np.concatenate([np.array(x.ids, np.int32) for x in self.letters.encode_batch_fast(blocks, add_special_tokens=False)])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):  # a vocabulary without word ends: no way to tell words apart
            return self._one_by_one(words)
        return ids, np.diff(ends, prepend=0)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        every = pa.array(words, pa.string())
        plain = pc.match_substring_regex(every, f"^[{LETTERS}]+[.,;:!?]*$").to_numpy(zero_copy_only=False)
        size, start = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        parts: list[np.ndarray] = []
        used = 0
        if plain.any():
            some = every.filter(pa.array(plain))
            stem = pc.utf8_rtrim(pc.utf8_lower(some), ".,;:!?")
            tail = pc.replace_substring_regex(some, f"^[{LETTERS}]+", "")
            coded = stem.dictionary_encode()
            ids, sizes = self._encode_letters(coded.dictionary.to_pylist())
            code = coded.indices.to_numpy()
            first = (np.cumsum(sizes) - sizes)[code]
            tails = tail.dictionary_encode()
            mark = self.marks.rows(tails.dictionary.to_pylist())[tails.indices.to_numpy()]
            both_start = np.stack([first, self.marks.start[mark] + len(ids)], axis=1).reshape(-1)
            both_size = np.stack([sizes[code], self.marks.length[mark]], axis=1).reshape(-1)
            parts.append(gathered(np.concatenate([ids, self.marks.flat[: self.marks.used]]), both_start, both_size))
            size[plain] = both_size.reshape(-1, 2).sum(axis=1)
            start[plain] = np.cumsum(size[plain]) - size[plain]
            used = len(parts[-1])
        if not plain.all():
            ids, sizes = self._one_by_one([w for w, p in zip(words, plain.tolist()) if not p])
            parts.append(ids)
            size[~plain] = sizes
            start[~plain] = used + np.cumsum(sizes) - sizes
        return gathered(np.concatenate(parts), start, size), size

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray, Words]:
        """All ids one after the other, the place where each text starts (and the end), and the texts' words.

        With `end` each text's ids are followed by that id.
        """
        words = Words(texts)
        rows = self.words.rows(words.vocab.to_pylist())[words.code] if len(words) else np.empty(0, np.int64)
        size = self.words.length[rows].astype(np.int64)
        total = np.concatenate(([0], np.cumsum(size)))
        bounds = total[words.start]
        ids = self.words.joined(rows)
        if end is not None:
            ids = np.insert(ids, bounds[1:], end)
            bounds = bounds + np.arange(len(bounds))
        return ids, bounds, words


@cache
def word_tokens(file: str) -> WordTokens:
    """One tokenizer per Python worker."""
    return WordTokens(file)
