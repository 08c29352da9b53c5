"""Values, calibration, sampling and reports."""

import math
import random

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from gavel.catalog import modelling
from gavel.catalog.tables import Tables
from gavel.functions import scalar
from gavel.functions.titles import parse_titles
from gavel.model import win_model as wm
from gavel.operators import evaluation as ev
from gavel.operators import exploration as x
from gavel.operators.blocks import double_blocks, running
from gavel.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from tests.conftest import same

SCORED = "auctionid long, bid int, is_winner boolean, cashvalue int, fee double, is_bidomatic boolean, prob double"


def scored(spark, n=2000, seed=3):
    r = random.Random(seed)
    rows = [
        (i, r.randint(1, 300), r.random() < 0.1, r.randint(1, 60), r.choice([0.0, 1.0, 1.99]), r.random() < 0.5, r.randint(0, 100) / 100.0)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, SCORED), rows


def test_calibration(spark):
    got = spark.range(1).select(wm.calibrate(F.lit(0.5), 0.01, 1 / 3)).first()[0]
    assert math.isclose(got, 0.015 / (0.015 + 0.7425))


def test_expected_value(spark):
    row = spark.createDataFrame([(1, 100, False, 50, 1.0, True, 0.1)], SCORED)
    got = ev.expected(row).first()
    assert math.isclose(got.potential, 47.6) and math.isclose(got.ep, 4.4)


def test_whole_dollar_and_exact_profit(spark):
    row = spark.createDataFrame([(1, 150, True, 10, 0.0, True, 0.1, "u")], SCORED + ", username string")
    assert math.isclose(x.win_profile(row).first().profit_avg, 8.6)
    assert math.isclose(ev.profits(row).first().potential, 8.1)


def test_grid_places_values_as_comparisons_do(spark):
    values = [i / 100.0 for i in range(-50, 151)] + [0.123456, 0.999999, 1e-9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for steps in (10, 20, 100):
        got = df.select("v", scalar.grid_below(F.col("v"), steps, True).alias("lt"), scalar.grid_below(F.col("v"), steps, False).alias("le")).collect()
        for r in got:
            grid = range(-2 * steps, 3 * steps)
            below = sum(1 for k in grid if k / steps < r.v) - 2 * steps
            upto = sum(1 for k in grid if k / steps <= r.v) - 2 * steps
            assert (r["lt"], r["le"]) == (below, upto), (steps, r)


def test_sweep_against_brute_force(spark):
    df, rows = scored(spark)
    got = {round(r.thresh, 2): r for r in ev.threshold_sweep(df).collect()}
    for k in range(8, 23):
        bets = [r for r in rows if r[6] >= k / 20]
        tp = sum(r[2] for r in bets)
        r = got[round(k / 20, 2)]
        assert (r.tp, r.fp, r.fn) == (tp, len(bets) - tp, sum(q[2] for q in rows) - tp)
        profit = sum((q[3] - q[4] - q[1] / 100 if q[2] else 0) - 0.4 for q in bets)
        assert math.isclose(r.profit, profit, abs_tol=1e-4)


def test_chunks_against_brute_force(spark):
    df, rows = scored(spark)
    ep = []
    for r in rows:
        gain = r[3] - r[4] - r[1] / 100
        value = r[6] * (gain - 0.4) - (1 - r[6]) * 0.4
        if value > 0:
            ep.append((value, (gain if r[2] else 0) - 0.4))
    ordered = sorted(e for e, _ in ep)
    want = []
    for i in range(0, len(ordered) - 100, 100):
        lo, hi = ordered[i], ordered[i + 100]
        want.append((i // 100, round(lo, 6), round(hi, 6), round(sum(a for e, a in ep if lo - 1e-12 <= e < hi - 1e-12), 4)))
    got = sorted((r.chunk, round(r.low, 6), round(r.high, 6), round(r.profit, 4)) for r in ev.ev_chunks(df, 100).collect())
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(math.isclose(g[3], w[3], abs_tol=1e-3) for g, w in zip(got, want))


def test_undersample_is_exact_and_repeatable(spark):
    df, rows = scored(spark, 5000)
    won = sum(r[2] for r in rows)
    once = wm.undersample(df, "is_winner", 0.5, ["auctionid", "bid"])
    counts = {r.is_winner: r["count"] for r in once.groupBy("is_winner").count().collect()}
    assert counts == {True: won, False: 2 * won}
    again = wm.undersample(df.repartition(5), "is_winner", 0.5, ["auctionid", "bid"])
    assert once.select("auctionid").exceptAll(again.select("auctionid")).isEmpty()


def test_shuffled_column_is_a_permutation(spark):
    df, rows = scored(spark, 800)
    out = wm.shuffled_column(df, "cashvalue", ["auctionid", "bid"], 5).collect()
    assert sorted(r.cashvalue for r in out) == sorted(r[3] for r in rows)
    before = {r[0]: r[3] for r in rows}
    assert sum(before[r.auctionid] != r.cashvalue for r in out) > 400


def test_running_totals_over_nested_blocks(spark):
    r = random.Random(1)
    rows = [(r.choice("ab"), i, r.randint(1, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, i long, v long").withColumns(
        {"coarse": F.expr("i div 100"), "fine": F.expr("i div 10")}
    )
    got = {(q.k, q.i): q.total for q in running(df, ["k"], ["coarse", "fine"], ["i"], {"total": F.col("v")}).collect()}
    for k in "ab":
        total = 0
        for kk, i, v in rows:
            if kk == k:
                total += v
                assert got[(k, i)] == total


def test_blocks_follow_the_order_of_doubles(spark):
    rng = random.Random(5)
    values = [0.0, 1.0, 2.0, 5e-324, 1e-300, -1.0] + [s * (2.0**k + e) for k in range(-40, 40) for e in (0, 1e-16, -1e-16) for s in (1, -1)]
    values += [rng.random() / 100 for _ in range(3000)]
    rows, names = double_blocks(spark.createDataFrame([(v,) for v in set(values)], "v double"), F.col("v"), "b")
    placed = sorted((r.v, tuple(r[n] for n in names)) for r in rows.collect())
    keys = [k for _, k in placed]
    assert keys == sorted(keys)


def test_sweep_of_close_probabilities(spark):
    """All values lie within a hundredth of each other, as those of a rare outcome do."""
    rng = random.Random(9)
    data = [(i, 1, rng.random() < 0.3, 10, 1.0, True, 0.009 * rng.random()) for i in range(400)]
    df = spark.createDataFrame(data, SCORED)
    got = {r.thresh: (r.tp, r.fp) for r in ev.sweep_every_probability(df, above=0.0).collect()}
    for p in rng.sample([d[-1] for d in data], 20):
        above = [d for d in data if d[-1] >= p]
        assert got[p] == (sum(d[2] for d in above), sum(not d[2] for d in above))


def test_undersample_refines_the_cut(spark, monkeypatch):
    """With coarse first ranges the finer ones decide; any levels keep the same rows."""
    df, _ = scored(spark, 5000)
    keys = ["auctionid", "bid"]
    usual = sorted(wm.undersample(df, "is_winner", 0.5, keys).select(*keys).collect())
    monkeypatch.setattr(wm, "HASH_LEVELS", (59, 57, 54))
    assert sorted(wm.undersample(df, "is_winner", 0.5, keys).select(*keys).collect()) == usual


def test_giveup_next_to_the_rate_of_its_group(spark):
    df = spark.createDataFrame([(1, 0.5, True), (1, 0.5, False), (1, 0.7, False), (1, 0.7, False), (2, 0.5, True)], "g int, p double, giveup boolean")
    got = {(r.g, r.p): (r.avg_giveup, r.giveup_frac) for r in x.giveup_against_group(df, "g", F.col("p"), "p").collect()}
    assert got == {(1, 0.5): (0.25, 0.5), (1, 0.7): (0.25, 0.0), (2, 0.5): (1.0, 1.0)}


def test_long_titles(spark):
    """Numbers behind a hundred and more characters count."""
    zeros = "0" * 300
    titles = [f"${zeros}25 Shop Gift Card AND {zeros}30 Bids (${zeros}40)", f"{zeros}50 Voucher Bids (${zeros}20)"]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    got = {r.title: r for r in parse_titles(df, "title").collect()}
    assert (got[titles[0]].cashvalue, got[titles[0]].cardvalue) == (40, 25)
    assert got[titles[1]].bidvalue == 50


def test_histogram_has_no_range(spark):
    from gavel.operators.exploration import histogram

    df = spark.createDataFrame([(-3.0,), (0.0,), (0.5,), (1000.0,), (None,)], "v double")
    assert {r.bin: r.n for r in histogram(df, F.col("v"), 2.0).collect()} == {-2: 1, 0: 2, 500: 1}


def test_titles(spark):
    given = {
        "$50 Amazon Gift Card AND 30 Bids ($62)": (62, 50, "Amazon", 30),
        "$25 Walmart Gift Card ($25)": (25, 25, "Walmart", 0),
        "50 Voucher Bids ($20)": (20, 0, "None", 50),
        "The Two Buster ($40)": (40, 30, "Buster", 25),
        "$5 Mug ($5)": (None, None, None, None),
    }
    df = spark.createDataFrame([(t,) for t in given], "title string")
    got = {r.title: (r.cashvalue, r.cardvalue, r.cardtype, r.bidvalue) for r in parse_titles(df, "title").collect()}
    assert got == given


def test_sunday_is_the_weekend(spark):
    days = spark.sql("SELECT timestamp_ntz'2024-01-06 10:00:00' AS sat, timestamp_ntz'2024-01-07 10:00:00' AS sun")
    row = days.select(scalar.is_weekend(F.col("sat")).alias("sat"), scalar.is_weekend(F.col("sun")).alias("sun")).first()
    assert (row.sat, row.sun) == (False, True)


def test_voucher_value_rounds_away_from_zero(spark):
    df = spark.createDataFrame([(4, 75), (1, 0), (75, 50)], "cash int, card int")
    got = [r[0] for r in df.select(scalar.voucher_value(F.col("cash"), F.col("card"))).collect()]
    assert got == [-178, 3, 63]


def test_permutation_importance_of_every_feature(spark):
    """All features in one job, equal to shuffling and scoring a column by itself."""
    rows = modelling.modelled(Tables(spark, "/root/testdata/sf0.01"))
    model = modelling.fitted(rows)
    got = {r.feature: r for r in wm.permutation_importance(model, rows).collect()}
    assert set(got) == {*NUMERIC_FEATURES, *CATEGORICAL_FEATURES}
    hit = F.avg((F.col("predicted") == F.col("is_winner")).cast("double"))
    accuracy = model.score(rows).agg(hit).first()[0]
    for col in ("cashvalue", "prevusers", "is_bidomatic0"):
        alone = model.score(wm.shuffled_column(rows, col, model.KEYS, 7)).agg(hit).first()[0]
        r = got[col]
        assert math.isclose(r.accuracy, accuracy) and math.isclose(r.shuffled, alone)
        assert math.isclose(r.importance, accuracy - alone, abs_tol=1e-12)


def test_permutation_scores_encoded_rows_that_change(spark):
    """Rows are encoded once, not once a feature; slots are where the assembler puts a feature."""
    rows = modelling.modelled(Tables(spark, "/root/testdata/sf0.01"))
    model = modelling.fitted(rows)
    encoder = PipelineModel(stages=model.model.stages[:-1])
    names = wm.feature_names(model.model, rows)
    for c, (at, n) in wm.feature_slots(encoder, [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]).items():
        assert [x == c or x.startswith(f"{c}_") for x in names[at : at + n]] == [True] * n
    plan = wm.permutation_importance(model, rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "cardtype_idx" not in plan and "_hot" not in plan


def test_rows_to_model_are_written_once(spark, sf_dir, monkeypatch):
    """Without long auctions the wide rows are marked in the exchange that made them; with one they are joined."""
    labels = []
    write = modelling.written
    monkeypatch.setattr(modelling, "written", lambda df, label: labels.append(label) or write(df, label))
    t = Tables(spark, sf_dir)
    rows = modelling.modelled(t)
    assert labels == ["model_rows"]
    same(rows, wm.model_rows(t.full), modelling.KEY)
    plan = wm.model_rows(t.full, together=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(auctionid") <= t.full._jdf.queryExecution().executedPlan().toString().count(
        "Exchange hashpartitioning(auctionid"
    )
    monkeypatch.setattr(modelling, "has_long", lambda bids: True)
    same(modelling.modelled(t), rows, modelling.KEY)


def test_saved_model_scores_where_rows_are_read(spark):
    """Both models score a row in one pass, without a join of their scores."""
    got = modelling.model_saved(Tables(spark, "/root/testdata/sf0.01"))
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    rows = got.collect()
    assert rows and got.columns == ["auctionid", "bid", "loaded", "fitted"]
    assert all(r.loaded == r.fitted for r in rows)
