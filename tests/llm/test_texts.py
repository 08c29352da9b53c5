"""Operators on single texts: language, quality, tokens, packing, URLs."""

import base64
import hashlib
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gavel.llm import bpe, language, packing, quality, queries, tokenfile, urls
from gavel.llm.ragged import RunCache
from gavel.llm.wordtokens import word_tokens
from gavel.session import work_folder
from tests.llm import brute
from tests.llm.conftest import prose

WORD_FILE, RANKS = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(WORD_FILE)
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tik():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_quality_equals_brute_force(docs, odd_texts, none):
    got = {r.doc_id: r for r in quality.repetition(docs, keep=["doc_id"]).collect()}
    assert len(got) == len(odd_texts)
    for i, text in odd_texts:
        r, want = got[i], brute.quality(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        shares = brute.repeated_shares(text, quality.NGRAM_SHARE)
        assert r.dup_ngram_share == pytest.approx(max(shares.values()))
        over = any(shares[n] > most for n, most in quality.NGRAM_SHARE.items()) or r.dup_line_share > quality.LINE_SHARE
        assert r.kept == (not want[-1] and not over)
    assert quality.repetition(none).count() == 0


def test_quality_query_equals_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op8_repetition(spark, sf_dir).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(texts[r.doc_id])


def test_language_held_out(spark, sf_dir):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op5_language(spark, sf_dir).collect()
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (brute.remainder(r.doc_id, 3) == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


def test_language_learns_in_bounded_memory():
    """One large batch takes no more than a slice of it, and counts what its rows count by themselves."""
    texts = [prose(i, 4000) for i in range(40)] * 12  # about 11 MB
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["a", "b"] * (len(texts) // 2))], ["text", "label"])
    assert batch.nbytes > 9 << 20
    tracemalloc.start()
    got = pa.Table.from_batches(language.counted(iter([batch]))).group_by(["label", "bucket"]).aggregate([("n", "sum")])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 << 20
    _, bucket = language._grams(pa.array(texts[0:40:2]))
    want = np.bincount(bucket, minlength=language.BUCKETS) * 12
    own = got.filter(pc.equal(got["label"], "a"))
    assert dict(zip(own["bucket"].to_pylist(), own["n_sum"].to_pylist())) == {i: n for i, n in enumerate(want.tolist()) if n}


def test_language_slices_are_small():
    batch = pa.RecordBatch.from_arrays([pa.array([prose(i, 4000) for i in range(160)]), pa.array(["a", "b"] * 80)], ["text", "label"])
    tracemalloc.start()
    list(language.counted(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20


def test_packing_leaves_no_words_in_the_worker():
    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    run = packing.packed(Docs(), packing.PackParams(WORD_FILE))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([prose(1, 500), "ein Haus"])], ["doc_id", "text"])
    first = [x.to_pydict() for x in run(iter([batch]))]
    assert not word_tokens(WORD_FILE).words.row and not word_tokens(WORD_FILE).marks.row
    assert [x.to_pydict() for x in run(iter([batch]))] == first


def test_language_odd_rows(spark, sf_dir, docs, none):
    model = language.learn(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    got = {r.doc_id: r for r in language.identified(docs.withColumn("score", F.lit("clash")), model).collect()}
    assert len(got) == docs.count()
    for i in (5, 6, 7, 25):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[13].lang_pred in model.languages
    assert language.identified(none, model).count() == 0
    assert {r.lang_pred for r in language.identified(docs, language.learn(none)).collect()} == {"und"}


def test_language_mixture(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.learn(texts)
    one, two = (texts.where(F.col("lang") == x).orderBy(F.desc("n_chars")).first().text for x in ("de", "es"))
    size = min(len(one), len(two), 3000)
    names, share, count = model.mixtures(pa.array([one[:size] + " " + two[: size // 3], one[:size]]))
    assert names == ["de", "de"] and list(count) == [2, 1]
    assert 0.6 < share[0] < 0.9 and share[1] > 0.99


def test_byte_bpe_equals_library(docs, odd_texts, tik, none):
    got = {r.doc_id: r for r in bpe.encoded(docs, RANKS, public_tokenizers.PATTERN).collect()}
    for i, text in odd_texts:
        assert got[i].ids == tik.encode_ordinary(text or "") and bytes(got[i].decoded) == (text or "").encode()
        assert got[i].n_tokens == len(got[i].ids)
    digests = {r.doc_id: r for r in bpe.encoded(docs, RANKS, public_tokenizers.PATTERN, digests=True).collect()}
    for i, text in odd_texts:
        assert digests[i].ids_sha256 == hashlib.sha256(" ".join(map(str, got[i].ids)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encoded(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_long_match(tik):
    codec = bpe.byte_bpe(RANKS, public_tokenizers.PATTERN)
    for text in ("ab" * 3000, "the" * 2000 + "q", "é" * 700):
        assert codec.encode(pa.array([text]))[0].tolist() == tik.encode_ordinary(text)


def test_word_tokens_equal_library(odd_texts, library):
    texts = [t or "" for _, t in odd_texts]
    ids, bounds, _ = word_tokens(WORD_FILE).encode(pa.array(texts), 1)
    for k, text in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == library(text) + [1]


def packed_rows(rows, want):
    """Checks pieces against each document's ids; returns the length of every sequence."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == crc(want[r.doc_id][r.start : r.start + r.length]) and r.doc_tokens == len(want[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(want)
    for i, found in pieces.items():
        at = 0
        for start, length in sorted(found):
            assert start == at and length > 0
            at += length
        assert at == len(want[i])
    sizes = []
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        sizes.append(at)
    return sizes


def test_packing(docs, odd_texts, library, none):
    params = packing.PackParams(WORD_FILE)
    rows = packing.packed(docs, params).withColumn("ids_crc32", F.crc32("ids")).collect()
    sizes = packed_rows(rows, {i: library(t) + [1] for i, t in odd_texts})
    assert all(n == 2048 or n & (n - 1) == 0 for n in sizes)
    assert packing.packed(none, params).count() == 0


def test_packing_query(spark, sf_dir, library):
    want = {r.doc_id: library(r.text) + [1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sizes = packed_rows(queries.op3_packing(spark, sf_dir).collect(), want)
    padded = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes)
    assert padded <= 0.01 * sum(sizes)


def test_packing_takes_neighbours_first():
    texts = ["alpha beta gamma " * 20, "one two three " * 20, "alpha beta gamma delta " * 10, "uno dos tres " * 20]
    words = packing.Words(pa.array(texts))
    sequences = list(packing.packed_shard(np.array([60, 50, 40, 50]), words, packing.PackParams(WORD_FILE, window=100)))
    assert [p[0] for p in sequences[0]] == [0, 2]


def test_token_files(spark, docs, odd_texts, library, none):
    files = tokenfile.write_tokens(docs, work_folder(spark, "tokens"), WORD_FILE)
    got = {r.doc_id: r for r in tokenfile.read_tokens(spark, files, with_ids=True).collect()}
    at = 0
    for i, text in sorted(odd_texts):
        ids = library(text) + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), crc(ids))
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids
        at += len(ids)
    # Any token of a file, without decoding what stands before it.
    row = files.orderBy("part").first()
    system, place = tokenfile._opened(row.path)
    with system.open_input_file(place) as stream:
        reader = tokenfile.TokenFile(stream)
        ids = np.concatenate([ids for _, ids in reader])
        assert len(ids) == row.n_tokens
        for k in {0, 1, 511, 512, 513, len(ids) // 2, len(ids) - 1}:
            assert reader.token(k) == ids[k]
    empty = tokenfile.write_tokens(none, work_folder(spark, "tokens"), WORD_FILE)
    assert tokenfile.read_tokens(spark, empty).count() == 0


def test_codes_of_any_size():
    rng = np.random.default_rng(3)
    for ids in ([], [0], [255, 256, 65535, 65536, 2**32 - 1], rng.integers(0, 2**32, 3000), rng.integers(0, 50000, 5000)):
        codes = tokenfile.Codes.of(np.array(ids, np.uint32))
        assert codes.all().tolist() == list(ids)
        assert [codes.token(i) for i in range(0, len(ids), 7)] == list(ids)[::7]


def test_urls(spark):
    cases = {
        "http://a.Example.NET/en/x?q": ("a.example.net", "/en/x", "example.net/en/", "allow"), "https://net/": ("net", "/", "net/", "block"),
        "http://x.net": ("x.net", "", None, "allow"), "http://xnet/": ("xnet", "/", None, "allow"), "http://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"),
        "http://example.com/de": ("example.com", "/de", None, "allow"), "ftp://a.b.org/fr/#x": ("a.b.org", "/fr/", "org/fr/", "allow"),
        "no scheme": ("", "", None, "allow"), "http://q.net?x=/en/": ("q.net", "", None, "allow"), "x://y://z.net/": ("y:", "//z.net/", None, "allow"),
        "http://.net/": (".net", "/", "net/", "block"), "http://" + "a." * 3000 + "net/" + "b/" * 3000: ("a." * 3000 + "net", "/" + "b/" * 3000, "net/", "block"), "": ("", "", None, "allow"),
    }
    rows = [(i, url, "clash") for i, url in enumerate([*cases, None, "http://x.net/"])] + [(0, next(iter(cases)), "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = urls.judged(pages, urls.rules_frame(spark)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.url in cases:
            assert (r.host, r.path, r.rule, r.verdict) == cases[r.url]
    assert urls.judged(pages.limit(0), urls.rules_frame(spark)).count() == 0
    assert {r.verdict for r in urls.judged(pages, urls.rules_frame(spark).limit(0)).collect()} == {"allow"}


def test_markers_in_texts_are_ids_of_their_own(library):
    texts = ["Hello <|endoftext|> world", "a<|startoftext|>b<|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext|><|endoftext|>", "<|endoftext"]
    ids, bounds, _ = word_tokens(WORD_FILE).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [library(t) for t in texts]
    assert 49407 in ids


def test_run_cache_starts_anew_beyond_its_room():
    cache = RunCache(lambda keys: (np.array([len(k) for k in keys], np.int32), np.ones(len(keys), np.int64)), room=50)
    for k in range(20):
        keys = ["x" * (k + 1), "y" * 30, "x" * (k + 1)]
        assert cache.joined(cache.rows(keys)).tolist() == [k + 1, 30, k + 1]
        assert cache.held + cache.used <= 50 + 2 * 54
