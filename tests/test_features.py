"""Literal fixtures for the per-bid features, history and opponents."""

import datetime as dt
import random

import pytest

from gavel.operators import history as h
from gavel.operators.bid_features import bid_transform, with_prev_win_bids
from gavel.operators.opponents import (
    auction_full,
    directly_followed,
    every_opponent,
    opponent_pairs,
    opponent_runs,
    opponents,
    opponents_at,
)
from gavel.schemas import FEATURE_COLUMNS
from gavel.sources import derived
from tests.conftest import by_key, make_auctions, make_bids, same

ISLANDS = [(1, i + 1, "a", t) for i, t in enumerate([True, True, False, False, True])]


@pytest.mark.parametrize("width", [1 << 16, 2])
def test_streak_numbers_colliding_islands_as_one(spark, width):
    bids, auctions = make_bids(spark, ISLANDS), make_auctions(spark, [1])
    rows = by_key(bid_transform(bids, auctions, width=width), "bid")
    assert [rows[(i,)]["prestreak"] for i in range(1, 6)] == [0, 0, 2, 2, 2]
    assert [rows[(i,)]["bom_streak"] for i in range(1, 6)] == [1, 2, 0, 0, 3]
    strict = by_key(bid_transform(bids, auctions, strict_islands=True, width=width), "bid")
    assert [strict[(i,)]["bom_streak"] for i in range(1, 6)] == [1, 2, 0, 0, 1]


def test_same_user_twice_is_dropped(spark):
    bids = make_bids(spark, [(1, 1, "a", True), (1, 2, "b", True), (1, 3, "b", True)])
    rows = by_key(auction_full(bids, make_auctions(spark, [1])), "bid")
    assert sorted(rows) == [(1,), (2,)]
    assert rows[(1,)]["username0"] is None and rows[(2,)]["username0"] == "a"


@pytest.mark.parametrize("width", [1 << 16, 2])
def test_nearest_opponents(spark, width):
    bids = make_bids(spark, [(1, i + 1, u, False) for i, u in enumerate("abcad")])
    row = by_key(auction_full(bids, make_auctions(spark, [1]), width=width), "bid")[(5,)]
    assert [row[f"username{i}"] for i in range(4)] == ["a", "c", "b", None]
    assert [row[f"distance{i}"] for i in range(4)] == [1, 2, 3, None]
    assert row["prevusers"] == 3


def test_tied_end_times_count_each_other(spark):
    when = [dt.datetime(2024, 1, 1, 12)] * 2
    bids = make_bids(
        spark, [(1, i, "a", True) for i in (1, 2, 3)] + [(2, i, "a", True) for i in (1, 2, 3, 4)]
    )
    rows = by_key(h.user_history(h.rollup(bids, make_auctions(spark, [1, 2], when))), "auctionid")
    assert (rows[(1,)]["prev_bid_count"], rows[(2,)]["prev_bid_count"]) == (4, 3)
    assert (rows[(1,)]["prev_auction_count"], rows[(2,)]["prev_auction_count"]) == (0, 1)


def test_previous_win(spark):
    bids = make_bids(spark, [(1, 1, "b", True), (1, 2, "u", True), (2, 1, "u", True), (2, 2, "u", False)])
    auctions = make_auctions(spark, [1, 2], bidvalue=50)
    rows = by_key(with_prev_win_bids(bid_transform(bids, auctions)), "auctionid", "bid")
    assert rows[(2, 1)]["prev_win_bids"] == 50 and rows[(2, 2)]["prev_win_bids"] == 50
    assert rows[(1, 2)]["prev_win_bids"] == 0


def test_busy_day_of_one_user(spark):
    """Auctions within seconds, minutes and days: history and last win as a plain walk gives them."""
    n, rng = 240, random.Random(4)
    start = dt.datetime(2024, 1, 1, 23, 30)
    when = [start + dt.timedelta(seconds=15 * i + (86_400 * 3 if i > 200 else 0)) for i in range(n)]
    won = [rng.random() < 0.4 for _ in range(n)]
    data = []
    for i in range(n):
        data += [(i, 1, "u", True), (i, 2, "v", True)] + ([(i, 3, "u", False)] if won[i] else [])
    bids, auctions = make_bids(spark, data), make_auctions(spark, list(range(n)), when, bidvalue=50)
    hist = by_key(h.user_history(h.rollup(bids, auctions)), "username", "auctionid")
    rows = by_key(with_prev_win_bids(bid_transform(bids, auctions)), "auctionid", "bid")
    for i in range(n):
        own = hist[("u", i)]
        assert own["prev_auction_count"] == i and own["prev_wins_count"] == sum(won[:i])
        assert own["prev_bid_count"] == i + sum(won[:i])
        assert rows[(i, 1)]["prev_win_bids"] == (50 if i and won[i - 1] else 0)


def test_history_in_one_exchange_equals_blocks(spark, sf_dir):
    """Days within the width run in one window; the form for busy days gives the same, ties included."""
    bids = derived.bids(spark, sf_dir)
    for day_times in (False, True):
        rolled = h.rollup(bids, derived.auctions(spark, sf_dir, day_times)).localCheckpoint()
        light = h.user_history(rolled)
        same(light, h.user_history(rolled, width=1), ["auctionid", "username"])
        plan = light._jdf.queryExecution().optimizedPlan().toString()
        # The rows are read and shuffled once; the only other input are the days' written totals.
        assert plan.count("LogicalRDD") == 1 and plan.count("Relation") == 1 and plan.count("RepartitionByExpression") == 1


def test_new_user_has_defaults(spark):
    bids = make_bids(spark, [(1, 1, "a", True), (1, 2, "b", True)])
    row = by_key(auction_full(bids, make_auctions(spark, [1])), "bid")[(2,)]
    assert row["prev_is_new_user0"] == 1 and row["prev_auction_count0"] == 1
    assert row["prev_bids0"] == 0 and row["prev_wins0"] == 0


def test_zero_cash_value_gives_no_share(spark):
    row = by_key(bid_transform(make_bids(spark, [(1, 1, "a", True)]), make_auctions(spark, [1], cashvalue=0)), "bid")[(1,)]
    assert row["perc_to_bin"] is None and row["is_winner"] and not row["giveup"]


def test_columns(spark, sf_dir):
    full = auction_full(derived.bids(spark, sf_dir), derived.auctions(spark, sf_dir))
    assert full.columns == FEATURE_COLUMNS and len(FEATURE_COLUMNS) == 82


def test_blocks_do_not_change_the_result(spark, sf_dir):
    bids, auctions = derived.bids(spark, sf_dir), derived.auctions(spark, sf_dir)
    key = ["auctionid", "bid"]
    for strict in (False, True):
        same(
            bid_transform(bids, auctions, strict_islands=strict),
            bid_transform(bids, auctions, strict_islands=strict, width=5),
            key,
        )
    same(auction_full(bids, auctions), auction_full(bids, auctions, width=7), key)
    for pairs in (every_opponent, opponent_pairs):
        same(pairs(bids), pairs(bids, width=6), key + ["p_username"])


def test_fused_history_equals_the_join(spark, sf_dir):
    bids, auctions = derived.bids(spark, sf_dir), derived.auctions(spark, sf_dir)
    transformed = bid_transform(bids, auctions)
    joined = h.unify(transformed, h.user_history(h.rollup_transformed(transformed)))
    same(
        auction_full(bids, auctions),
        directly_followed(opponents(joined)).select(*FEATURE_COLUMNS),
        ["auctionid", "bid"],
    )


def test_opponents_against_brute_force(spark, sf_dir):
    bids = derived.bids(spark, sf_dir)
    rows = [r.asDict() for r in bids.collect()]
    want = set()
    for n in rows:
        latest = {}
        for p in rows:
            if p["auctionid"] == n["auctionid"] and p["bid"] < n["bid"] and p["username"] != n["username"]:
                latest[p["username"]] = max(latest.get(p["username"], 0), p["bid"])
        want |= {(n["auctionid"], n["bid"], u, b) for u, b in latest.items()}
    got = {(r.auctionid, r.bid, r.p_username, r.max_bid) for r in every_opponent(bids, width=9).collect()}
    assert got == want
    runs = opponent_runs(bids, width=9)
    spread = runs.collect()
    seen = {(n["auctionid"], n["bid"]) for n in rows}
    got = {
        (r.auctionid, b, r.p_username, r.max_bid) for r in spread for b in range(r["first"], r["last"] + 1) if (r.auctionid, b) in seen
    }
    assert got == want and sum(r.times_seen for r in spread) == len(want)
    assert len(spread) <= len(rows)
    auction, bid = max(seen)
    one = {tuple(r) for r in opponents_at(runs, auction, bid).collect()}
    assert one == {w for w in want if w[:2] == (auction, bid)}


def test_hot_auction_and_hot_user(spark):
    """One auction and one user hold most rows; blocks keep results whole."""
    users = ["hot", "x", "hot", "y", "z", "hot"]
    rows = [(1, i + 1, users[i % 6], i % 4 != 0) for i in range(3000)]
    rows += [(a, b, "hot" if b % 2 else f"v{a}", True) for a in range(2, 60) for b in range(1, 6)]
    bids, auctions = make_bids(spark, rows), make_auctions(spark, range(1, 60))
    same(auction_full(bids, auctions), auction_full(bids, auctions, width=256), ["auctionid", "bid"])
    last = by_key(bid_transform(bids, auctions, width=256), "auctionid", "bid")[(1, 3000)]
    assert last["bids_so_far"] == 1500 and last["is_winner"] and last["prevusers"] == 3


def test_cutoff_leaves_later_auctions(spark):
    bids = make_bids(spark, [(a, b, f"u{b}", True) for a in (1, 2, 3) for b in (1, 2)])
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    rows = bid_transform(bids, make_auctions(spark, [1, 2, 3], days), "2024-01-03", done=bids.where("auctionid = 1"))
    assert {r.auctionid for r in rows.collect()} == {2}
