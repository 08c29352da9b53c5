"""Operators on the whole corpus: scores, near-duplicates, passages, neighbours, the pipeline."""

import math
import os
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gavel.llm import neardup, neighbours, ngrams, oracles, queries, substrings
from gavel.llm.eliasfano import EliasFano
from gavel.llm.tables import components, stored, working_tables
from tests.llm import brute
from tests.llm.conftest import DOCS, prose


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, top in [(0, 10), (1, 1), (5, 3), (1000, 10), (1000, 10**6), (20000, 2**55)]:
        values = np.sort(rng.integers(0, top, n)).astype(np.uint64)
        found, _ = EliasFano.read(np.frombuffer(EliasFano.of(values).write(), np.uint8), 0)
        assert (found.at(np.arange(n)) == values).all()
        ask = np.concatenate([rng.integers(0, top + 5, 500).astype(np.uint64), values[:500]])
        place, hit = found.successor(ask)
        assert (place == np.searchsorted(values, ask)).all() and (hit == np.isin(ask, values)).all()


def check_scores(rows, texts, trains, params=ngrams.NgramParams()):
    want = brute.ngram_scores(texts, trains, params.discount)
    assert len(rows) == len(want)
    for r in rows:
        n, known, total, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6)
        assert abs(r.score - score) <= n * 0.5 * -ngrams.LOWEST / ngrams.LEVELS + 1e-9  # half a level a token


def test_ngram_scores(docs, odd_texts, none):
    trains = F.col("doc_id") % 4 != 1
    check_scores(ngrams.scored(docs, trains).collect(), odd_texts, lambda i: i % 4 != 1)
    # Many small slices and shards, and split contexts.
    small = ngrams.NgramParams(slice_bytes=500, shard_tokens=300, hot_share=0.05)
    check_scores(ngrams.scored(docs, trains, small).collect(), odd_texts, lambda i: i % 4 != 1, small)
    assert ngrams.scored(none, trains).count() == 0
    flat = ngrams.scored(docs, F.lit(False)).collect()
    assert {r.train_tokens for r in flat} == {0} and all(r.n_known == 0 and r.score == pytest.approx(r.base_score) for r in flat)


def test_ngram_query(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = queries.op1_ngram_scores(spark, sf_dir).collect()
    check_scores(rows, texts, lambda i: brute.remainder(i, 5) != 1)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def check_near(rows, texts, n=4):
    want = brute.near_duplicates(texts, n)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicates(docs, odd_texts, none):
    check_near(neardup.near_duplicates(docs).collect(), odd_texts)
    check_near(neardup.near_duplicates(docs, neardup.NearParams(words=5)).collect(), odd_texts, 5)
    assert neardup.near_duplicates(none).count() == 0


def test_near_duplicate_families(spark):
    """Edited copies around the threshold, with chains, sub-families and a passage that all share."""
    rng = np.random.default_rng(5)
    rows, passage = [], prose(99, 40)
    for family in range(6):
        base = prose(family, 120).split() + (passage.split() if family % 2 else [])
        for k in range(40):
            own = list(base)
            for at in rng.choice(len(own), size=int(rng.integers(0, 9)), replace=False):
                own[at] = f"w{family}x{rng.integers(0, 30)}"
            if k % 5 == 0:
                base = own  # later copies follow an edited one
            rows.append((len(rows), " ".join(own[: len(own) - int(rng.integers(0, 12))])))
    for k in range(40):
        rows.append((len(rows), passage + " " + prose(1000 + k, int(rng.integers(1, 30)))))
    check_near(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_near_duplicates_odd_ids(spark):
    rows = [(None, prose(1, 50)), (3, prose(1, 50)), (3, prose(1, 50)), (None, prose(2, 50)), (None, None), (4, "")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted(((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in got))
    assert found == [(-1, 0, -1, True), (-1, 47, -1, True), (-1, 47, 3, False), (3, 47, 3, True), (3, 47, 3, True), (4, 0, 4, True)]


def test_substrings(docs, odd_texts, none):
    want = brute.substrings(odd_texts)
    got = substrings.without_repeats(docs.select("doc_id", "text", F.lit(1).alias("place"))).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want
    assert substrings.without_repeats(none).count() == 0
    texts = dict(odd_texts)
    for r in substrings.without_repeats(docs, text_out=True).collect():
        assert (r.text == texts[r.doc_id]) if r.n_removed == 0 else (len(brute.words(r.text)) == r.n_words - r.n_removed)


def test_substrings_one_id_two_texts(spark):
    """A row loses what its own text shares with smaller ids, whatever other rows of its id have."""
    copied, own, passage, tail = prose(1, 40), prose(2, 40), prose(3, 20), prose(4, 30)
    rows = [(1, copied), (5, copied), (5, own), (9, own), (2, passage), (7, passage + " " + tail), (7, prose(5, 60)), (None, own), (5, own)]
    got = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), text_out=True).collect()
    found = sorted((r.doc_id or -1, r.n_words, r.n_removed, r.text) for r in got)
    assert found == sorted([
        (1, 40, 0, copied), (5, 40, 40, ""), (5, 40, 0, own), (5, 40, 0, own), (9, 40, 40, ""), (2, 20, 0, passage),
        (7, 50, 20, tail), (7, 60, 0, prose(5, 60)), (-1, 40, 0, own),
    ])


def test_substrings_survive_a_full_sketch(docs, odd_texts, monkeypatch):
    """With next to no cells every window passes the filter, and the result is the same."""
    monkeypatch.setattr(substrings, "_bits", lambda size: 5)
    want = brute.substrings(odd_texts)
    got = substrings.without_repeats(docs.select("doc_id", "text")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want


class _Task:
    """Stands for rows: keeps the functions that tasks run."""

    def __init__(self):
        self.functions = []

    def mapInArrow(self, function, schema):
        self.functions.append(function)
        return self

    def __getattr__(self, name):
        return lambda *_: self

    def toLocalIterator(self):
        return iter(())


def test_substrings_count_in_bounded_memory():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 2000)) for _ in range(750)]  # 21 MB in one batch
    batch = pa.RecordBatch.from_arrays([pa.array(texts + texts[:2], pa.string())], ["text"])
    bits, params, task = 22, substrings.SubstringParams(), _Task()
    assert not substrings.repeated_cells(task, bits, params, lambda given: given).any()
    tracemalloc.start()
    handed = [(x.column("block")[0].as_py(), x.column("counts")[0].as_py()) for x in task.functions[0](iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20
    total = np.zeros(substrings.ROWS << bits, np.int64)
    for block, data in handed:
        cells, counts = substrings._cells_of(data)
        total[cells + (block << substrings.BLOCK_BITS)] += counts
    own = np.zeros_like(total)
    for part in substrings.slices([batch], 1 << 20):
        for row, cell in enumerate(substrings._once(substrings._Windows(substrings.texts_of(part), params), bits)):
            own += np.bincount(cell + (row << bits), minlength=len(own))
    assert ((total >= 2) == (own >= 2)).all() and ((total == 0) == (own == 0)).all()


def test_substring_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = {r[0]: r[1:] for r in con.execute(oracles.STATEMENTS["op6_substrings"]).fetchall()}
    assert {r[0]: tuple(r[1:]) for r in queries.op6_substrings(spark, sf_dir).collect()} == want


def nearest_by_force(rows, every, k):
    own = {i: np.array(v, float) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q in own:
        if q % every == 0:
            cos = {i: float(own[q] @ v / math.sqrt((own[q] @ own[q]) * (v @ v))) for i, v in own.items() if i != q}
            out[q] = sorted(cos.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def test_neighbours_exact_in_one_range(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(30)] + [(400, None), (450, [0.0] * 6), (500, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (550, [float("nan")] * 6), (600, [float("inf")] + [0.0] * 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(frame, 10).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = nearest_by_force(rows, 10, 5)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)
    assert neighbours.nearest(frame.limit(0)).count() == 0
    assert neighbours.nearest(frame.where("vec_id < 3"), 2).count() == 4  # fewer candidates than asked for


def test_neighbours_recall(spark):
    """Many ranges, groups split by hash: recall against brute force."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=24)]) for i in range(4000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    params = neighbours.CurveParams(least=100, group=50)
    got = {}
    for r in neighbours.nearest(frame, 50, params).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = nearest_by_force(rows, 50, 5)
    assert np.mean([len(got[q] & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        kept[name] = (before, {r.doc_id: r.text for r in docs.collect()})
    before, after = kept["language"]
    assert set(after) == set(before)  # every text here has a language
    before, after = kept["quality"]
    assert all(not brute.quality(t)[-1] for t in after.values()) and len(after) > 0.85 * len(before)
    before, after = kept["near-duplicates"]
    assert {i for i, (_, c) in brute.near_duplicates(before.items(), 5).items() if i == c} == set(after)
    before, after = kept["passages"]
    want = brute.substrings(before.items())
    assert set(after) == set(before)
    assert all(len(brute.words(t)) == want[i][0] - want[i][1] for i, t in after.items())
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(after)


def test_pipeline_near_duplicates_odd_ids(spark, sf_dir):
    """One row of each group stays, also with repeated or null ids, and no other row goes."""
    a, b, c, d, e = (prose(i, 50) for i in range(1, 6))
    rows = [(1, a), (5, a), (5, b), (6, c), (6, c), (6, c), (None, d), (None, d), (None, e), (8, e), (None, None), (9, ""), (9, "")]
    docs = spark.createDataFrame([(i, t, None, f"s{k}", 0) for k, (i, t) in enumerate(rows)], DOCS).repartition(3)
    out = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    assert out.columns == docs.columns
    found = sorted(((r.doc_id or -1, r.text or "") for r in out.collect()))
    assert found == sorted([(1, a), (5, b), (6, c), (-1, d), (8, e), (-1, ""), (9, ""), (9, "")])


def test_pipeline_passages_odd_ids(spark, sf_dir):
    """A text that only another row of its id copies stays whole."""
    a, b = prose(1, 50), prose(2, 50)
    docs = spark.createDataFrame([(1, a, None, "", len(a)), (5, a, None, "", len(a)), (5, b, None, "", len(b))], DOCS)
    found = sorted((r.doc_id, r.text, r.n_chars) for r in corpus_pipeline.passages(spark, docs, sf_dir).collect())
    assert found == [(1, a, len(a)), (5, "", 0), (5, b, len(b))]


def test_pipeline_of_nothing(spark, none, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0


def test_stages_carry_clashing_columns(spark, docs, sf_dir):
    names = ["score", "lang_pred", "kept", "n_words", "n_removed", "__row", "component_id"]
    wide = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        wide = spark.createDataFrame(stage(spark, wide, sf_dir).collect(), wide.schema)
        assert wide.columns[-len(names):] == names
        rows = wide.collect()
        assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)


def test_working_tables_go_but_for_those_kept(spark):
    folder = lambda df: df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    keep = []
    with working_tables(keep):
        one, two = stored(spark.range(5), "one"), stored(spark.range(7), "two")
        gone, kept = folder(one), folder(two)
        keep.append(two)
    assert not os.path.exists(gone) and os.path.exists(kept) and two.count() == 7
    with pytest.raises(ZeroDivisionError), working_tables([]):
        left = folder(stored(spark.range(3), "left"))
        1 / 0
    assert os.path.exists(left)


def test_near_duplicate_pairs_of_a_family_below_the_threshold(spark, monkeypatch):
    """Copies with many edits each, linked with nobody, and two sub-families that leave the hub together."""
    rng = np.random.default_rng(3)
    base = prose(50, 200).split()
    rows = [(0, " ".join(base))]
    for k in range(1, 150):
        own = list(base)
        if k % 3 == 0:
            for at in range(k % 2, 200, 12):
                own[at] = f"sub{k % 2}x{at}"
        else:
            for at in rng.choice(200, size=int(rng.integers(8, 20)), replace=False):
                own[at] = f"w{at}x{rng.integers(0, 40)}"
        own[int(rng.integers(0, 200))] = f"only{k}"
        rows.append((k, " ".join(own)))
    tested = []
    plain = neardup._pairs
    monkeypatch.setattr(neardup, "_pairs", lambda left: tested.append(plain(left).count()) or plain(left))
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    check_near(found.collect(), rows)
    assert sum(tested) < 150 * 149 / 2 / 4  # members of one sub-family are never paired with each other


def test_near_duplicate_family_with_a_much_edited_hub(spark, monkeypatch):
    """Copies with two edits are similar to each other, but not to the first one, which has three and is the family's hub."""
    rng = np.random.default_rng(5)
    base = prose(51, 150).split()
    rows = []
    for k in range(150):
        own = list(base)
        for at in rng.choice(150, size=3 if k == 0 else 2 if k % 3 else int(rng.integers(7, 10)), replace=False):
            own[at] = f"w{k}x{at}"
        rows.append((k, " ".join(own)))
    tested, linked = [], []
    plain, components_of = neardup._pairs, neardup.components
    monkeypatch.setattr(neardup, "_pairs", lambda left: tested.append(plain(left).count()) or plain(left))
    monkeypatch.setattr(neardup, "components", lambda edges: linked.append(edges.count()) or components_of(edges))
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    check_near(found.collect(), rows)
    assert sum(tested) < 5 * 150 and max(linked) < 2 * 150
