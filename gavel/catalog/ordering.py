"""Sorts, limits, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.catalog.tables import MIDWAY, Tables
from gavel.model.win_model import sample_losers
from gavel.operators import evaluation as ev
from gavel.operators.exploration import rounded
from gavel.operators.opponents import opponent_pairs

KEY = ["auctionid", "bid"]


def middle_of_head(t: Tables):
    """Rows 51 to 100 of the profit per bid, which are few."""
    per_bid = ev.bet_totals(t.scored, {"bid": F.col("bid"), "cashvalue": F.col("cashvalue")})
    return per_bid.orderBy("bid", "cashvalue").offset(50).limit(50).select("bid", "cashvalue", "actual")


def new_ids(t: Tables):
    """Auction ids of the bids that the stored auctions lack."""
    stored = t.auctions.where(F.col("auctiontime") < F.lit(MIDWAY).cast("timestamp_ntz"))
    return t.bids.select("auctionid").distinct().exceptAll(
        stored.select(F.col("qauctionid").alias("auctionid"))
    )


QUERIES = {
    "t01_order_by": lambda t: t.auctions.orderBy("auctiontime", "qauctionid").select("qauctionid", "auctiontime"),
    "t02_head": lambda t: ev.expected(t.scored).select(*KEY, rounded(F.col("ep")).alias("ep")).orderBy(
        F.desc("ep"), *KEY
    ).limit(25),
    "t02_tail_of_head": middle_of_head,
    "t03_four_latest_opponents": lambda t: opponent_pairs(t.bids),
    "t04_scan_cap": lambda t: t.auctions.select("qauctionid").orderBy("qauctionid").limit(100),
    "t05_winners_and_some_losers": lambda t: sample_losers(t.scored, "is_winner", 0.1, KEY),
    "t06_new_ids": new_ids,
}
