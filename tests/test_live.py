"""The feed, the stream state, and the pages."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gavel.operators import history as h
from gavel.operators.bid_features import bid_transform
from gavel.plans.batch import cutoffs, read_batches, run_batch, run_incremental, _batches
from gavel.operators.opponents import auction_full
from gavel.sources import derived, pages
from gavel.streaming import feed, live, run
from gavel.streaming.tracker import tracked_states
from tests.conftest import same


def body(bids, **more):
    return json.dumps({**more, "bh": [{"id": b, "u": f"u{b % 3}", "t": 2} for b in bids]})


def send(folder, spark, bodies, auction="7", start=0):
    for i, text in enumerate(bodies):
        rows = [(start + i, f'cb({{"a":{{"{auction}":{text}}}}})')]
        spark.createDataFrame(rows, "seq long, message string").coalesce(1).write.mode("append").json(folder)


def run_feed(spark, bodies, **kw):
    folder = tempfile.mkdtemp(prefix="gavel-test-")
    send(f"{folder}/feed", spark, bodies)
    states, board = run.track(spark, f"{folder}/feed", folder, "me", **kw)
    return live.latest_per_auction(states).withColumn("tracking_ok", live.tracking_ok()).first(), board


@pytest.mark.parametrize("max_files", [100, 1])
def test_merge_drops_repeats_and_stops_at_a_gap(spark, max_files):
    last, _ = run_feed(spark, [body(b, sl=9) for b in ([3, 2, 1], [4, 3], [3], [7, 6])], max_files=max_files)
    assert (last.n_bids, last.last_bid, last.tracking_ok) == (4, 4, True)


def test_late_join_is_flagged(spark):
    last, _ = run_feed(spark, [body([6, 5], sl=9)])
    assert (last.n_bids, last.last_bid, last.tracking_ok) == (2, 6, False)


def test_state_writes_follow_the_users_touched(spark):
    """Two bids in an auction of very many users rewrite two entries and the auction's own value."""
    n, folder = 30_000, tempfile.mkdtemp(prefix="gavel-test-")
    first = json.dumps({"sl": 9, "bh": [{"id": b, "u": f"u{b}", "t": 1} for b in range(n, 0, -1)]})
    later = json.dumps({"sl": 9, "bh": [{"id": n + 2, "u": "u7", "t": 2}, {"id": n + 1, "u": "u3", "t": 2}]})
    updates = []
    for i, text in enumerate((first, later)):
        send(f"{folder}/feed", spark, [text], start=i)
        parsed = feed.parse_feed(feed.read_feed(spark, f"{folder}/feed"))
        query = (
            tracked_states(parsed, "me").writeStream
            .foreachBatch(lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{folder}/out/b={batch_id}"))
            .outputMode("update").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        updates.append(max(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress))
    assert updates[0] >= n and updates[1] <= 10
    last = live.latest_per_auction(spark.read.parquet(f"{folder}/out").where("my_bid IS NULL")).first()
    assert (last.n_bids, last.prevusers) == (n + 2, n)
    assert [(e.username, e.bids_so_far, e.bom_streak) for e in last.opponents[:3]] == [("u7", 2, 1), ("u3", 2, 1), (f"u{n}", 1, 0)]


def test_few_users_are_one_state_row(spark):
    """An auction of twenty users is read and written once a trigger, not once a user."""
    folder = tempfile.mkdtemp(prefix="gavel-test-")
    send(f"{folder}/feed", spark, [json.dumps({"sl": 9, "bh": [{"id": b, "u": f"u{b}", "t": 1} for b in range(20, 0, -1)]})])
    query = (
        tracked_states(feed.parse_feed(feed.read_feed(spark, f"{folder}/feed")), "me").writeStream
        .foreachBatch(lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{folder}/out/b={batch_id}"))
        .outputMode("update").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress) == 1


def test_users_move_to_the_map(spark):
    """The same states whether an auction passes the limit of users in one trigger or over several."""
    names = [f"u{b % 50}" for b in range(60)] + [f"u{b % 70}" for b in range(60, 210)] + ["u0", "u69", "new"]
    bodies = [
        json.dumps({"sl": 9, "bh": [{"id": b, "u": names[b - 1], "t": 2 if b % 3 else 1} for b in range(hi, hi - 30, -1) if b > 0]})
        for hi in [*range(30, 211, 30), len(names)]
    ]
    cols = ["n_bids", "last_bid", "last_user", "prevusers", "opponents"]
    got = []
    for max_files in (100, 1):
        folder = tempfile.mkdtemp(prefix="gavel-test-")
        send(f"{folder}/feed", spark, bodies)
        states, _ = run.track(spark, f"{folder}/feed", folder, "me", every=True, max_files=max_files)
        got.append(states.select(*cols).orderBy("n_bids").collect())
    assert got[0] == got[1]
    last = got[0][-1]
    assert (last.n_bids, last.last_user, last.prevusers) == (len(names), "new", 71)
    assert [(e.username, e.bids_so_far) for e in last.opponents] == [(u, names.count(u)) for u in ("new", "u69", "u0", names[208])]


@pytest.mark.parametrize("max_files", [100, 1])
def test_state_before_own_bids(spark, max_files):
    """Repeats and late messages give no second row; my first bid of an auction has no state before it."""
    folder = tempfile.mkdtemp(prefix="gavel-test-")
    mine = lambda bids, **more: json.dumps({**more, "bh": [{"id": b, "u": "me" if b % 2 else f"u{b % 3}", "t": 2} for b in bids]})
    send(f"{folder}/feed", spark, [mine([1], sl=9), mine([3, 2, 1], sl=9), mine([3, 2], sl=9), mine([5, 4], sl=9), mine([9, 8], sl=9)])
    send(f"{folder}/feed", spark, [mine([7, 6], sl=9)], start=1)  # late: seq 1 again
    run.track(spark, f"{folder}/feed", folder, "me", max_files=max_files)
    rows = run.emitted_states(spark, folder).where("my_bid IS NOT NULL").orderBy("my_bid").collect()
    assert [(r.my_bid, r.n_bids, r.last_user, r.prevusers) for r in rows] == [(3, 2, "u2", 1), (5, 4, "u1", 2)]


def test_board_slots_turn(spark):
    """More triggers than slots: the board is whole, and only so many versions are kept."""
    folder = tempfile.mkdtemp(prefix="gavel-test-")
    for i in range(5):
        send(f"{folder}/feed", spark, [body([1], sl=9)], auction=str(i))
    _, board = run.track(spark, f"{folder}/feed", folder, "me", max_files=1)
    assert {r.auction_id for r in board.collect()} == {str(i) for i in range(5)}
    assert len([x for x in os.listdir(f"{folder}/board") if x.startswith("slot=")]) == live.SLOTS


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    from gavel.catalog.tables import Tables
    from gavel.model.win_model import WinModel, model_rows
    from pyspark.ml.classification import RandomForestClassifier

    t = Tables(spark, sf_dir)
    rows = model_rows(t.full).cache()
    # Few rows: every category gets at least two values, and each card type one.
    names = [r.cardtype for r in t.auctions.select("cardtype").distinct().collect()]
    flags = ["is_bidomatic", "limited_allowed", *[f"is_bidomatic{i}" for i in range(4)]]
    more = rows.limit(1).withColumn("cardtype", F.explode(F.array(*map(F.lit, names))))
    more = more.withColumn("auctiontime", F.explode(F.array(*[F.lit(f"2024-01-0{d} 10:00:00").cast("timestamp_ntz") for d in (7, 8)])))
    more = more.withColumn("flag", F.explode(F.array(F.lit(True), F.lit(False), F.lit(None)))).withColumns({c: F.col("flag") for c in flags})
    seen = rows.unionByName(more.drop("flag"))
    path = tempfile.mkdtemp(prefix="gavel-test-") + "/model"
    WinModel(RandomForestClassifier(numTrees=3, maxDepth=3, seed=1), sampling_ratio=1.0).fit(rows, seen).save(path)
    return path


def test_board_valued_by_a_loaded_model(spark, sf_dir, fitted):
    """Messages to expected values in one streaming query, the same as the batch features scored afterwards."""
    from gavel.catalog.joins import snapshot
    from gavel.catalog.tables import Tables
    from gavel.model.win_model import WinModel

    t = Tables(spark, sf_dir)
    few = t.bids.where("auctionid < 6")
    users, folder = snapshot(t).cache(), tempfile.mkdtemp(prefix="gavel-test-")
    run.write_feed(feed.render_feed(few).repartition(2), f"{folder}/feed")
    model = WinModel.load(spark, fitted)
    value = lambda rows: live.live_ev(rows.withColumn("auctiontime", F.lit("2024-02-01 12:00:00").cast("timestamp_ntz")), model)
    _, board = run.track(spark, f"{folder}/feed", folder, "u1", valued=run.valued_rows(t.auctions, users, value, "u1"))
    states = live.latest_per_auction(live.live_states_batch(few, t.auctions, "u1").withColumn("seq", F.col("n_bids")))
    want = value(live.live_features(states, t.auctions, users, me="u1"))
    cols = ["auctionid", "bid", "bom_proba", "manual_proba", "potential_profit", "bom_ev", "manual_ev"]
    assert board.count() > 0
    same(board.select(*cols), want.select(*cols), ["auctionid"])


def test_latest_whole_list(spark):
    """Lists of several files, mixed and sent twice: a list counts when all of it is there."""
    folder = tempfile.mkdtemp(prefix="gavel-test-")
    lists = {k: live.listed(spark.range(n).withColumn("name", F.lit(f"list {k}")), k) for k, n in ((1, 7), (2, 5), (3, 9))}
    for k in (2, 1):
        lists[k].repartition(3).write.mode("append").json(f"{folder}/lists")
    lists[3].where("id < 8").repartition(2).write.mode("append").json(f"{folder}/lists")  # one row is still to come
    lists[2].where("id = 1").write.mode("append").json(f"{folder}/lists")
    schema = lists[1].schema
    got = run.replace_latest(spark, f"{folder}/lists", schema, f"{folder}/out", max_files=2)
    assert sorted((r.id, r.name) for r in got.collect()) == [(i, "list 2") for i in range(5)]
    lists[3].where("id = 8").write.mode("append").json(f"{folder}/lists")
    assert run.replace_latest(spark, f"{folder}/lists", schema, f"{folder}/out").count() == 9


def test_complete_leaves_the_board(spark):
    last, board = run_feed(spark, [body([1], sl=9), '{"sl":20}', body([2, 1], sl=3, s="x")])
    assert last.complete and last.is_live and board.count() == 0


@pytest.mark.parametrize("max_files", [100, 1])
def test_what_follows_the_sold_mark_is_ignored(spark, max_files):
    """The same board and the same last state however messages fall into triggers."""
    bodies = [body([1], sl=9), body([2, 1], sl=3, s="x"), body([9, 8], sl=9), '{"sl":20}', body([3, 2], sl=9)]
    last, board = run_feed(spark, bodies, max_files=max_files)
    assert last.complete and (last.n_bids, last.last_bid) == (1, 1) and board.count() == 0


@pytest.mark.parametrize("max_files", [100, 1])
def test_odd_messages_change_what_they_have(spark, max_files):
    bodies = [body([1], sl=9), body([2, 1]), '{"sl":8,"bh":null}', '{"sl":7,"bh":[null,{"id":null,"u":"u1","t":1}]}', body([3, 2], sl=6)]
    last, _ = run_feed(spark, bodies, max_files=max_files)
    assert (last.n_bids, last.last_bid, last.sl, last.tracking_ok) == (3, 3, 6, True)
    rows = [(i, f'cb({{"a":{{"7":{b}}}}})') for i, b in enumerate(bodies + ["5"])]
    odd = feed.odd_messages(spark.createDataFrame(rows, "seq long, message string"))
    assert {r.seq for r in odd.collect()} == {1, 2, 5}


def test_sequence_numbers_of_a_long_auction(spark):
    """Bid numbers above 100,000 stay before the next auction's."""
    bids = spark.createDataFrame([(1, 250_000), (2, 1)], "auctionid long, bid int").withColumns(
        {"username": F.lit("u1"), "is_bidomatic": F.lit(True)}
    )
    seq = {r.auction_id: r.seq for r in feed.parse_feed(feed.render_feed(bids)).collect()}
    assert seq["1"] < seq["2"]


def test_message_kinds(spark):
    bodies = [body([1], sl=1, s="x"), body([1], sl=1), '{"sl":20}', '{"sl":12}', "{}", "5"]
    rows = [(i, f'cb({{"a":{{"7":{b}}}}})') for i, b in enumerate(bodies)]
    got = feed.classify(spark.createDataFrame(rows, "seq long, message string")).orderBy("seq").collect()
    assert [r.kind for r in got] == ["complete", "bids", "live", None, None, None]


def test_a_message_is_read_once(spark, sf_dir):
    """No step of the reading is repeated for another column or for a filter."""
    rows = feed.feed_bids(feed.parse_feed(feed.render_feed(derived.bids(spark, sf_dir))))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 1 and plan.count("StructsToJson") <= 1


def test_messages_do_not_depend_on_blocks(spark):
    """Gaps, a bid number that is there twice, and blocks shorter than a message."""
    at = [1, 2, 3, 4, 6, 7, 7, 8, 11]
    bids = spark.createDataFrame([(5, b, f"u{i}", i % 2 == 0) for i, b in enumerate(at)], "auctionid long, bid int, username string, is_bidomatic boolean")
    want = {b: sorted((x for x in enumerate(at) if b - 3 < x[1] <= b), key=lambda x: (x[1], f"u{x[0]}"), reverse=True) for b in at}
    for width in (1 << 16, 2, 1):
        got = feed.parse_feed(feed.render_feed(bids, width=width)).collect()
        assert len(got) == len(want)
        assert {r.bh[0].id: [(int(e.u[1:]), e.id) for e in r.bh] for r in got} == want


def test_message_without_auctions(spark):
    df = spark.createDataFrame([(1, 'cb({"a":{}})'), (2, "cb(x)"), (3, None)], "seq long, message string")
    assert [(r.auction_id, r.kind) for r in feed.classify(df).collect()] == [(None, None)] * 3


def test_payload_may_hold_a_parenthesis(spark):
    df = spark.createDataFrame([('cb({"a":{"7":{"sl":20,"n":":)"}}})',)], "message string")
    assert feed.classify(df).first().kind == "live"


def test_stream_equals_batch(spark, sf_dir):
    bids, auctions = derived.bids(spark, sf_dir), derived.auctions(spark, sf_dir)
    folder = tempfile.mkdtemp(prefix="gavel-test-")
    run.write_feed(feed.render_feed(bids), f"{folder}/feed")
    states, _ = run.track(spark, f"{folder}/feed", folder, "u1", every=True)
    cols = ["auction_id", "n_bids", "last_bid", "last_user", "prevusers"]
    wide = [F.get("opponents", F.lit(i))[c].alias(f"{c}{i}") for i in range(4) for c in ("username", "bid", "bids_so_far", "bom_streak")]
    same(
        states.select(*cols, *wide),
        live.live_states_batch(bids, auctions, "u1", width=8).select(*cols, *wide),
        ["auction_id", "n_bids"],
    )


def test_kept_bids_with_blocks(spark):
    rows = [(s, "7", 9, p, b, "u", True) for s, bs in enumerate([[3, 2, 1], [4, 3], [7, 6]]) for p, b in enumerate(bs)]
    df = spark.createDataFrame(rows, "seq long, auction_id string, sl int, pos int, bid int, username string, is_bidomatic boolean")
    for width in (1 << 16, 2):
        assert sorted(r.bid for r in live.kept_bids(df, width).collect()) == [1, 2, 3, 4]


def test_kept_bids_read_messages_once(spark, sf_dir):
    """Neither the start of an auction nor the carry-ins parse the feed again."""
    rows = live.kept_bids(feed.feed_bids(feed.parse_feed(feed.render_feed(derived.bids(spark, sf_dir)))))
    assert "regexp_extract" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.count() == derived.bids(spark, sf_dir).count()


def test_pages_parse_back(spark, sf_dir):
    bids, auctions = derived.bids(spark, sf_dir), derived.auctions(spark, sf_dir)
    same(pages.parse_bids(pages.render_history(bids, per_page=7)), bids, ["auctionid", "bid"])
    parsed = pages.parse_auctions(pages.render_pages(auctions)).na.fill(0, ["lock_price"])
    want = auctions.withColumn("auctiontime", F.date_trunc("second", "auctiontime").cast("timestamp_ntz"))
    same(parsed, want, ["qauctionid"])


def test_empty_history_page(spark):
    page = spark.createDataFrame([("1", "<td>a</td><td>b</td><td>c</td>"), ("2", "")], "auction_id string, history_html string")
    assert pages.parse_bids(page).count() == 0


def test_upcoming_list_ends_at_the_first_far_row(spark):
    clocks = ["00:01:00", "00:05:00", "01:00:00", "00:02:00"]
    rows = "".join(
        f'<tr class="tr-inner"><td>x</td><td><a>{i}</a></td><td>L$25 Shop Gift Card ($25)</td><td>{c}</td></tr>'
        for i, c in enumerate(clocks)
    )
    df = spark.createDataFrame([(1, rows)], "page_id long, html string")
    got = pages.parse_upcoming(df).orderBy("auctionid").collect()
    assert [(r.auctionid, r.seconds_left, r.limited_allowed) for r in got] == [("0", 60, True), ("1", 300, True)]


def test_incremental_equals_one_run(spark, sf_dir):
    bids, auctions = derived.bids(spark, sf_dir), derived.auctions(spark, sf_dir)
    out = tempfile.mkdtemp(prefix="gavel-test-")
    counts = run_incremental(spark, bids, auctions, out, ["2024-01-10", "2024-01-10", "2024-02-01"])
    assert counts["2024-01-10"] == 0 and counts["2024-02-01"] > 0
    full = f"{out}/auction_full"
    same(read_batches(spark, full, _batches(spark, full)), auction_full(bids, auctions), ["auctionid", "bid"])


def test_batch_reads_its_sources_once(spark, sf_dir, monkeypatch):
    """A batch's feature tables are planned over its written bids and auctions alone, and equal those of one run."""
    from gavel.operators import bid_features
    from gavel.plans import batch

    built = []
    build = lambda bids, auctions, *a, **k: built.append((bids, auctions)) or bid_features.bid_transform(bids, auctions, *a, **k)
    monkeypatch.setattr(batch, "bid_transform", build)
    monkeypatch.setattr("gavel.operators.opponents.bid_transform", build)
    bids, auctions = derived.bids(spark, sf_dir), derived.auctions(spark, sf_dir)
    out = tempfile.mkdtemp(prefix="gavel-test-")
    run_incremental(spark, bids, auctions, out, ["2024-01-15", "2024-02-01"])
    sources = ("events.parquet", "part.parquet")
    assert len(built) == 4  # two tables a batch
    for pair in built:
        assert not any(f.endswith(sources) for df in pair for f in df.inputFiles())
    table = f"{out}/bid_transform"
    same(read_batches(spark, table, _batches(spark, table)), bid_features.bid_transform(bids, auctions), ["auctionid", "bid"])
    rollup = f"{out}/rollup"
    whole = h.rollup_transformed(bid_features.bid_transform(bids, auctions))
    same(read_batches(spark, rollup, _batches(spark, rollup)), whole, ["auctionid", "username"])


def test_batch_cut_short_is_redone(spark, sf_dir):
    bids, auctions = derived.bids(spark, sf_dir), derived.auctions(spark, sf_dir)
    out = tempfile.mkdtemp(prefix="gavel-test-")
    # The first table was written, the second was not.
    bid_transform(bids, auctions, "2024-01-10").write.parquet(f"{out}/bid_transform/batch=2024-01-10")
    assert run_batch(spark, bids, auctions, out, "2024-01-10") > 0
    folders = _batches(spark, f"{out}/bid_transform")
    got = read_batches(spark, f"{out}/bid_transform", folders)
    assert got.count() == got.select("auctionid", "bid").distinct().count()


def test_cutoffs_include_both_ends():
    import datetime as dt

    assert cutoffs(dt.date(2024, 1, 30), dt.date(2024, 2, 1)) == ["2024-01-30", "2024-01-31", "2024-02-01"]
