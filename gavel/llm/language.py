"""Language identification as inference in a mixture (operator 5).

A text is a bag of hashed byte trigrams. Its likelihood is that of a mixture of
languages whose trigram distributions are learned from labelled texts;
expectation-maximisation estimates the text's language proportions. The set of
languages is selected by penalised likelihood: starting from all, the language
with the smallest proportion goes as long as the penalised likelihood doesn't
fall. The language with the largest proportion is the prediction and its
proportion the score.

Learning counts trigrams per task and sums the counts per (language, bucket):
at most languages x 2**15 numbers reach the driver and the tasks, however large
the corpus. Prediction is map-only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavel.llm.words import slices, texts_of, tidied

BITS = 15
BUCKETS = 1 << BITS
UNKNOWN = "und"
ROUNDS = 12
FLOOR = 0.02  # a language with a smaller proportion is a candidate for leaving at once
SLICE_BYTES = 1 << 19  # text per slice: its trigrams take some 50 times as much memory
PENALTY = 8.0  # log-likelihood a further language must gain, times log of the trigrams


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every trigram of letters and word edges, lower-cased."""
    plain = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}]+", " ")
    padded = pc.binary_join_element_wise(" ", plain, " ", "")
    buffer = b"".join(padded.cast(pa.binary()).to_pylist())
    data = np.frombuffer(buffer, np.uint8).astype(np.uint32)
    size = pc.binary_length(padded).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(size)), size)
    if len(data) < 3:
        return doc[:0], data[:0].astype(np.int64)
    word = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    with np.errstate(over="ignore"):
        bucket = ((word * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)
    same = (doc[:-2] == doc[2:]) & (data[1:-1] != 32)  # the middle byte is a letter's
    return doc[:-2][same], bucket[same]


def _counts(doc: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, bucket) in order of text, with their counts."""
    key = np.sort(doc * BUCKETS + bucket)
    if not len(key):
        return key, key, key
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first] >> BITS, key[first] & (BUCKETS - 1), np.diff(np.append(first, len(key)))


@dataclass
class LanguageModel:
    languages: list[str]
    logp: np.ndarray  # languages x buckets

    def mixtures(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Best language, its proportion and the number of selected languages, per text."""
        n, kinds = len(texts), len(self.languages)
        doc, bucket, count = _counts(*_grams(texts))
        share = np.zeros((n, kinds))
        active = np.zeros((n, kinds), bool)
        known = np.zeros(n, bool)
        known[doc] = True
        if kinds and len(doc):
            share, active = self._fit(doc, bucket, count, n)
        best = share.argmax(axis=1) if kinds else np.zeros(n, int)
        has_letter = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
        known &= has_letter & (kinds > 0)
        top = share[np.arange(n), best] if kinds else np.zeros(n)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        return names, np.where(known, np.clip(top, 0, 1), 0.0), np.where(known, active.sum(axis=1), 0)

    def _fit(self, doc, bucket, count, n) -> tuple[np.ndarray, np.ndarray]:
        kinds = len(self.languages)
        logp = self.logp[:, bucket].T.astype(np.float64)
        top = logp.max(axis=1)
        p = np.exp(logp - top[:, None])
        weight = count.astype(np.float64)
        total = np.bincount(doc, weights=weight, minlength=n)
        at = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        rows = doc[at]
        fixed = np.zeros(n)
        fixed[rows] = np.add.reduceat(weight * top, at)
        price = PENALTY * np.log(np.maximum(total, 2))

        def by_text(values: np.ndarray) -> np.ndarray:
            out = np.zeros((n,) + values.shape[1:])
            out[rows] = np.add.reduceat(values, at, axis=0)
            return out

        def fitted(active: np.ndarray, todo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Proportions and log-likelihood of the texts `todo` over their active languages."""
            share = np.where(active, 1.0, 0.0)
            share /= np.maximum(share.sum(axis=1, keepdims=True), 1)
            pick = todo[doc]
            d, q, w = doc[pick], p[pick], weight[pick]
            if not len(d):
                return share, np.zeros(n)
            first = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
            for _ in range(ROUNDS):
                part = q * share[d]
                part *= (w / np.maximum(part.sum(axis=1), 1e-300))[:, None]
                share[d[first]] = np.add.reduceat(part, first, axis=0) / total[d[first], None]
            like = np.zeros(n)
            like[d[first]] = np.add.reduceat(w * np.log(np.maximum((q * share[d]).sum(axis=1), 1e-300)), first)
            return share, like + fixed

        single = by_text(weight[:, None] * logp)  # log-likelihood of each language alone
        one = single.argmax(axis=1)
        one_like = single[np.arange(n), one]
        alone = np.zeros((n, kinds))
        alone[np.arange(n), one] = 1.0
        everyone = np.ones((n, kinds), bool)
        share, like = fitted(everyone, total > 0)
        active = everyone.copy()
        value = like - price * (kinds - 1)
        # Backward elimination; texts drop out as soon as leaving a language costs them.
        todo = total > 0
        for _ in range(kinds - 1):
            size = active.sum(axis=1)
            todo = todo & (size > 1)
            if not todo.any():
                break
            lowest = np.where(active, share, np.inf).argmin(axis=1)
            trial = active.copy()
            trial[np.arange(n)[todo], lowest[todo]] = False
            small = (share < FLOOR) & trial & todo[:, None]
            small[np.arange(n), share.argmax(axis=1)] = False
            trial &= ~small
            trial_share, trial_like = fitted(trial, todo)
            trial_value = trial_like - price * (trial.sum(axis=1) - 1)
            better = todo & (trial_value >= value)
            active[better], share[better], value[better] = trial[better], trial_share[better], trial_value[better]
            todo = better
        solo = (one_like >= value) & (total > 0)  # the best single language is always a candidate
        share[solo], active[solo] = alone[solo], alone[solo] > 0
        return share, active


@tidied
def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label, bucket, n of a task's rows; its memory is that of one slice of text, whatever the batches hold."""
    sums: dict[str, np.ndarray] = {}
    for part in slices(batches, SLICE_BYTES):
        labels = part.column("label").to_pylist()
        names = sorted(set(labels))
        place = {x: i for i, x in enumerate(names)}
        doc, bucket = _grams(texts_of(part))
        row = np.array([place[x] for x in labels])[doc]
        table = np.bincount(row * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
        for name, own in zip(names, table):
            sums[name] = sums[name] + own if name in sums else own
    for name, own in sums.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at].astype(np.int64))],
            ["label", "bucket", "n"],
        )


def learn(docs: DataFrame, text: str = "text", label: str = "lang") -> LanguageModel:
    """Trigram distributions per label, from every row with a text and a label.

    Rows with a null text or label teach nothing; without any labelled row the
    model has no languages and predicts `und`.
    """
    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(label).alias("label")
    )

    # At most languages x BUCKETS rows come back.
    found: pd.DataFrame = (
        rows.mapInArrow(counted, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    )
    languages = sorted(found["label"].unique())
    table = np.full((len(languages), BUCKETS), 0.1)
    place = {x: i for i, x in enumerate(languages)}
    if len(found):
        table[found["label"].map(place).to_numpy(), found["bucket"].to_numpy()] += found["n"].to_numpy()
    return LanguageModel(languages, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def identified(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """`docs` with lang_pred, score and n_languages (columns of these names are replaced).

    Null texts and texts without a letter are `und` with score 0; repeated
    rows are judged one by one; an empty table gives an empty result.
    """
    added = "lang_pred string, score double, n_languages int"
    names = [c.split()[0] for c in added.split(", ")]
    carried = [c for c in docs.columns if c not in names]
    rows = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text}`").alias("__text"))
    kinds = T.StructType([rows.schema[c] for c in carried] + list(T._parse_datatype_string(added)))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_BYTES, "__text"):
            lang, score, size = model.mixtures(texts_of(part, "__text"))
            new = [pa.array(lang, pa.string()), pa.array(score), pa.array(size.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([part.column(c) for c in carried] + new, carried + names)

    return rows.mapInArrow(run, kinds)
