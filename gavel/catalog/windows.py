"""Window features, one query per feature."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.catalog.tables import Tables
from gavel.operators import evaluation as ev
from gavel.operators import history as h
from gavel.operators.bid_features import bid_transform, with_prev_win_bids
from gavel.operators.exploration import rounded
from gavel.operators.opponents import directly_followed, opponents
from gavel.schemas import OPPONENT_COLUMNS
from gavel.session import written

KEY = ["auctionid", "bid"]


def _feature(*cols: str):
    return lambda t: t.transform.select(*KEY, *cols)


def ev_chunk_report(t: Tables):
    """Bets in EV order in runs of 1000, and the profit between the bounds."""
    return ev.ev_chunks(t.scored).select(
        "chunk", rounded(F.col("low")).alias("low"), rounded(F.col("high")).alias("high"), "bets", "profit"
    )


def older_opponents(t: Tables):
    """The earlier table: eight attributes per opponent, previous wins among them."""
    rows = written(with_prev_win_bids(t.transform), "bid_transform")
    attributes = [*OPPONENT_COLUMNS[:7], "prev_win_bids"]
    wide = directly_followed(opponents(rows, attributes=attributes))
    return wide.select(*KEY, *[f"{c}{i}" for i in range(4) for c in attributes])


def tied_history(t: Tables):
    """History when many auctions of a user end at the same instant."""
    return h.user_history(written(h.rollup(t.bids, t.day_auctions), "rollup"))


QUERIES = {
    "w01_eventual_win_price": _feature("eventual_win_price"),
    "w02_eventual_bids": _feature("eventual_bids"),
    "w03_bids_so_far": _feature("bids_so_far"),
    "w04_bids_of_this_type": _feature("bids_of_this_type"),
    "w05_prestreak": _feature("prestreak"),
    "w06_bom_streak": _feature("bom_streak"),
    "w06_strict_islands": lambda t: bid_transform(t.bids, t.auctions, strict_islands=True).select(*KEY, "bom_streak"),
    "w06_any_type_streak": lambda t: bid_transform(t.bids, t.auctions, any_type_streak=True).select(*KEY, "bom_streak"),
    "w07_debut": _feature("debut"),
    "w08_prevusers": _feature("prevusers"),
    "w09_prev_win_bids": lambda t: with_prev_win_bids(t.transform).select(*KEY, "username", "prev_win_bids"),
    "w09_prev_win_bids_tied": lambda t: with_prev_win_bids(bid_transform(t.bids, t.day_auctions)).select(
        *KEY, "username", "prev_win_bids"
    ),
    "w10_history_sums": lambda t: t.history.drop("prev_auction_count"),
    "w10_history_sums_tied": lambda t: tied_history(t).drop("prev_auction_count"),
    "w11_prev_auction_count": lambda t: t.history.select("username", "auctionid", "prev_auction_count"),
    "w11_prev_auction_count_tied": lambda t: tied_history(t).select("username", "auctionid", "prev_auction_count"),
    "w12_auction_full": lambda t: t.full,
    "w12_older_opponents": older_opponents,
    "w13_ev_chunks": ev_chunk_report,
}
