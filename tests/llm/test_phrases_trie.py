"""Collocations, SimHash near-duplicates and the prefix trie against plain re-statements and SQL."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gavel.llm import oracles, phrases, prefixtrie, queries, simhash
from gavel.llm.tables import components, stored
from tests.llm import brute
from tests.llm.conftest import prose
from tools.check import compare

TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
PHRASE = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
TURNS = "conv_id long, turn int, role string, text string"


def rows_of(df, columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def sql(name, table, sf_dir):
    con = duckdb.connect(config={"temp_directory": ""})
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con.execute(oracles.STATEMENTS[name]).df()


@pytest.fixture(scope="module")
def collocated():
    """(lang, text): frequent phrases of all lengths, nested ones, piece ends, copies, nulls, odd spaces."""
    rng = random.Random(4)
    rows = [(None, None), ("en", None), ("en", ""), ("en", " . , \n\t"), ("und", "new york " * 40), (None, "new york, new york " * 20)]
    parts = ["New York", "new york city", "of the", "a b c d e", "the end of the day", "é ß 中文", "x\x1cy z", "la la la la", "york"]
    for k in range(400):
        text = "".join(rng.choice(parts) + rng.choice([" ", ", ", ".", "\n", "\t", "  ", "! ", "\x0b"]) for _ in range(rng.randint(1, 30)))
        rows.append((rng.choice(["en", "en", "fr", None]), text))
    return rows + [("en", "one passage that many documents share word for word. " * 3)] * 50 + [("de", prose(1, 3000))]


@pytest.mark.parametrize("params", [
    phrases.PhraseParams(), phrases.PhraseParams(modulus=1, slice_bytes=2000), phrases.PhraseParams(modulus=3, bits=4, spread=2),
    phrases.PhraseParams(modulus=10**6, top=7), phrases.PhraseParams(longest=3, least=5), phrases.PhraseParams(longest=2, least=2),
])
def test_collocations(spark, collocated, params):
    docs = spark.createDataFrame([(t, lang, "x", 5) for lang, t in collocated], "text string, lang string, phrase string, f int")
    got = rows_of(phrases.collocations(docs.repartition(3), params), PHRASE)
    assert got == brute.collocations(collocated, params.least, params.longest, params.top) and got


def test_collocations_without_rows(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert phrases.collocations(spark.createDataFrame([("a b", None)], "text string, lang string")).count() == 0


def test_parse_counts_once(spark, collocated):
    """The cores of all chunks, weighted, are the tokens of all texts; copies give one chunk."""
    docs = spark.createDataFrame(collocated, "lang string, text string")
    found = phrases.chunks(docs, phrases.PhraseParams(modulus=4))
    row = found.agg(F.sum(F.col("core") * F.col("freq")).alias("n"), F.max("freq").alias("most")).first()
    texts = [t for _, t in collocated]
    import pyarrow as pa

    assert row.n == len(phrases.tokens(pa.array(texts, pa.string()))) and row.most >= 50


def test_collocations_query(spark, sf_dir):
    assert compare(queries.op11_collocations(spark, sf_dir).toPandas(), sql("op11_collocations", "documents", sf_dir)) == "ok"


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@pytest.fixture(scope="module")
def families():
    """Fingerprints around a few centres, some far apart, and lone ones."""
    rng = np.random.default_rng(1)
    out = {0, 1, 3, (1 << 64) - 1, 1 << 63}
    for family in range(4):
        centre = int(rng.integers(0, 2**63)) << (family % 2)
        for _ in range(80):
            mask = sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 5)), replace=False))
            out.add(centre ^ mask)
    return sorted(out | {int(x) for x in rng.integers(0, 2**63, 60)})


@pytest.mark.parametrize("params", [
    simhash.SimParams(), simhash.SimParams(parts=2, most=5), simhash.SimParams(parts=4, most=0), simhash.SimParams(parts=6, most=10**6),
    simhash.SimParams(parts=3, most=8, list_bits=4), simhash.SimParams(parts=4, distance=4, most=9), simhash.SimParams(parts=2, distance=0),
])
def test_links_of_fingerprints(spark, families, params):
    prints = stored(spark.createDataFrame([(signed(x),) for x in families], "print long"), "families")
    label = brute.components_within(families, params.distance)
    want = {x for x in families if sum(label[y] == label[x] for y in families) > 1}
    found = simhash.linked(prints, params)
    got = {} if found is None else {r.node % 2**64: r.label for r in components(found).collect()}
    assert set(got) == want
    assert len({(label[x], got[x]) for x in want}) == len({label[x] for x in want}) == len(set(got.values()))


def test_parts_group_correlated_bits():
    both = np.full((64, 64), 250.0)
    np.fill_diagonal(both, 500)
    for a, b in [(0, 63), (5, 40), (40, 41)]:
        both[a, b] = both[b, a] = 490
    layout = simhash.grouped_bits(both, np.full(64, 500.0), 1000, 3)
    part = {bit: i for i, own in enumerate(layout.parts) for bit in own}
    assert sorted(part) == list(range(64)) and part[0] == part[63] and part[5] == part[40] == part[41]
    assert {len(x) for x in layout.parts} == {21, 22}


def test_thresholds_sum(families):
    """Allocations obey the principle and cost no more than any other of the same sum."""
    prints = np.array(families, np.uint64)
    layout = simhash.Layout((tuple(range(20)), tuple(range(20, 44)), tuple(range(44, 64))))
    counts = [[np.bincount((layout.value(prints, p).astype(np.int64) >> shift) & ((1 << w) - 1), minlength=1 << w)
               for shift, w in zip((0, layout.halves(p)[0]), layout.halves(p))] for p in range(3)]
    costs = simhash.Costs.of(layout, counts, len(prints), 2)
    found = costs.thresholds(prints)
    assert (found.sum(axis=1) == 0).all()
    cost = [[np.zeros(len(prints)), *costs.estimated(prints, p)] for p in range(3)]
    total = lambda t: sum(np.choose(np.asarray(t)[..., p] + 1, cost[p]) for p in range(3))
    for other in [(0, 0, 0), (1, 0, -1), (-1, 1, 0), (2, -1, -1), (-1, -1, 2), (0, -1, 1)]:
        assert (total(found) <= total(np.tile(other, (len(prints), 1))) + 1e-9).all()


def check_simhash(rows, texts):
    prints = {i: brute.fingerprint(t) for i, t in texts}
    label = brute.components_within(prints.values(), 2)
    least = {}
    for i, p in prints.items():
        least[label[p]] = min(i, least.get(label[p], i))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{p:016x}", least[label[p]]) for i, p in prints.items()}


def test_simhash(docs, odd_texts, none):
    check_simhash(simhash.near_duplicates(docs).collect(), odd_texts)
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_query(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check_simhash(queries.op12_simhash(spark, sf_dir).collect(), texts)


def test_simhash_odd_rows(spark):
    rows = [(None, "a b c d"), (None, "lone text of its own"), (3, "A b c  d"), (3, "other words in here"), (1, None), (2, "")]
    docs = spark.createDataFrame([(*r, "p", 1) for r in rows], "doc_id long, text string, print string, first int")
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(docs).collect()}
    key = lambda i, t: (i, f"{brute.fingerprint(t):016x}")
    assert got[key(None, "a b c d")] == 3 and got[key(3, "a b c d")] == 3 and got[key(1, None)] == got[key(2, "")] == 1
    assert got[key(None, "lone text of its own")] is None


@pytest.fixture(scope="module")
def turns():
    """Null, tied, repeated and empty turns, negative ids, absent first conversations, two long ones that share most turns."""
    rng = random.Random(3)
    rows = []
    for c in range(-30, 120):
        if c % 20 == 0 and c % 3 == 0:
            continue
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            text = rng.choice(["", "x y", None, "z  w\tq", f"u{rng.randint(0, 3)}"])
            rows.append((c, rng.choice([None, t, t, 0]), rng.choice([None, "a", "b"]), text))
    rows += [(None, 1, "a", "b")] * 3 + [(7, t, "a", "same") for t in range(300)] + [(8, t, "a", "same") for t in range(250)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("params", [prefixtrie.TrieParams(), prefixtrie.TrieParams(members=3), prefixtrie.TrieParams(members=20, bits=4)])
def test_trie(spark, turns, params):
    table = spark.createDataFrame([(*r, 1, "x") for r in turns], TURNS + ", depth int, head string").repartition(7)
    assert rows_of(prefixtrie.trie(table, params), TRIE) == brute.trie(turns)


def test_trie_of_few_rows(spark):
    assert prefixtrie.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefixtrie.trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).count() == 0
    for rows in ([(5, 0, "a", "b c")], [(21, 0, "a", "b"), (22, 0, "a", "b")], [(40, 1, None, None)] * 3):
        assert rows_of(prefixtrie.trie(spark.createDataFrame(rows, TURNS)), TRIE) == brute.trie(rows)


def test_many_ends(spark):
    """More ids at one node than one piece of text holds."""
    rows = [(c, 0, "a", "hello there") for c in range(0, 20 * 700, 20)]
    assert rows_of(prefixtrie.trie(spark.createDataFrame(rows, TURNS)), TRIE) == brute.trie(rows)


def test_slots():
    rng = np.random.default_rng(2)
    h1, h2 = (rng.integers(0, 2**63, 5000).astype(np.uint64) for _ in range(2))
    h1[:100], h2[100:200] = h1[0], h2[100]  # half of a digest may repeat
    table = prefixtrie.Slots(h1, h2)
    slot = table.find(h1, h2)
    assert sorted(slot) == list(range(5000))
    assert (table.find(h1 + np.uint64(1), h2) == -1).all()


def test_trie_query(spark, sf_dir):
    assert compare(queries.op13_prefix_trie(spark, sf_dir).toPandas(), sql("op13_prefix_trie", "conversations", sf_dir)) == "ok"
