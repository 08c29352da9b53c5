"""Joins: enrichment, lookups, semi and anti joins, the opponent join."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.catalog.tables import MIDWAY, Tables
from gavel.operators import evaluation as ev
from gavel.operators import exploration as x
from gavel.operators import history as h
from gavel.operators.opponents import every_opponent, opponent_pairs, opponent_runs, opponents
from gavel.schemas import HISTORY_COLUMNS
from gavel.session import written
from gavel.sources.pages import clean_auctions, clean_bids, with_known_auction

KEY = ["auctionid", "bid"]
SNAPSHOT = [f"{c}0" for c in HISTORY_COLUMNS]


def snapshot(t: Tables, until: str | None = None):
    wide = opponents(
        h.unify(t.transform, t.history),
        attributes=["username", "distance", "bids_so_far", *HISTORY_COLUMNS],
    ).where(F.col("distance0").isNull() | (F.col("distance0") == 1))
    needed = ["username", "auctiontime", "username0", "bids_so_far0", *SNAPSHOT]
    return h.user_snapshot(written(wide.select(*needed), "auction_full"), until)


def rounded_snapshot(t: Tables, until: str | None = None):
    return snapshot(t, until).select("username", SNAPSHOT[0], *[x.rounded(F.col(c)).alias(c) for c in SNAPSHOT[1:]])


def user_lookup(t: Tables):
    """Snapshot values for all bidders and for names nobody has used."""
    names = t.bids.select("username").distinct()
    strangers = names.select(F.concat("username", F.lit("x")).alias("username"))
    found = h.lookup(names.unionByName(strangers), snapshot(t))
    return found.select(
        "username", "prev_is_new_user", "prev_auction_count",
        *[x.rounded(F.col(c)).alias(c) for c in HISTORY_COLUMNS[1:]],
    )


def live_rows(t: Tables):
    """Live-stored rows: both scenario probabilities of every bid."""
    return t.bids.select(
        *KEY,
        ((F.col("bid") * 7) % 100 / F.lit(100.0)).alias("bom_proba"),
        ((F.col("bid") * 3) % 100 / F.lit(100.0)).alias("manual_proba"),
    )


def live_against_batch(t: Tables):
    checked = ev.live_check(t.scored, live_rows(t))
    return checked.select(*KEY, *[x.rounded(F.col(c)).alias(c) for c in ("batch_ev", "live_ev", "actual")])


def representation_diff(t: Tables):
    """Rows whose streak or flags differ between the two island rules."""
    from gavel.operators.bid_features import bid_transform

    strict = bid_transform(t.bids, t.auctions, strict_islands=True)
    return ev.column_diff(t.transform, strict, KEY, ["bom_streak", "bids_so_far", "giveup", "is_winner"])


def orphan_bids(t: Tables):
    tracked, _ = clean_auctions(t.auctions)
    return with_known_auction(t.bids, tracked)


def excluded_bids(t: Tables):
    """Bids to load when the first days are stored and poor tracking is excluded."""
    _, excluded = clean_auctions(t.auctions)
    stored = t.joined.where(F.col("auctiontime") < F.lit(MIDWAY).cast("timestamp_ntz")).select("auctionid")
    return clean_bids(t.bids, excluded, stored)


def by_key_not_position(t: Tables):
    """Potential profit, probability and outcome side by side, matched by key."""
    priced = ev.profits(t.scored)
    return priced.select(*KEY, x.rounded(F.col("potential")).alias("potential")).join(
        t.scored.select(*KEY, "prob", "is_winner"), KEY
    )


def unified_rows(t: Tables):
    return h.unify(t.transform, t.history).drop("is_locked", "is_pen")


QUERIES = {
    "j01_bids_with_auctions": lambda t: t.joined,
    "j02_rows_with_history": unified_rows,
    "j03_latest_bid_per_opponent": lambda t: every_opponent(t.bids),
    "j03_opponent_runs": lambda t: opponent_runs(t.bids),
    "j03_nearest_opponents": lambda t: opponent_pairs(t.bids).drop("position"),
    "j04_opponent_lookup": lambda t: opponents(
        t.transform, attributes=["username", "distance", "bids_so_far", "bom_streak"]
    ).select(
        *KEY, *[f"{c}{i}" for i in range(4) for c in ("username", "distance", "bids_so_far", "bom_streak")]
    ),
    "j05_anti_join_new_bids": excluded_bids,
    "j06_semi_join_bidomatic": lambda t: t.bids.join(
        t.bids.where("is_bidomatic").select("auctionid").distinct(), "auctionid", "left_semi"
    ),
    "j07_user_snapshot": rounded_snapshot,
    "j07_user_snapshot_until": lambda t: rounded_snapshot(t, MIDWAY),
    "j08_snapshot_lookup": user_lookup,
    "j09_user_profile": lambda t: x.user_profile(t.transform),
    "j10_live_against_batch": live_against_batch,
    "j11_column_diff": representation_diff,
    "j12_known_auction": orphan_bids,
    "j13_concat_by_key": by_key_not_position,
}
