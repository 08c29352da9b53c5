"""Expected value, profit and calibration reports on pseudo-probabilities."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.catalog.joins import live_rows
from gavel.catalog.tables import Tables
from gavel.operators import evaluation as ev
from gavel.operators.bid_features import with_auction
from gavel.operators.exploration import rounded
from gavel.functions import scalar

KEY = ["auctionid", "bid"]


def priced(t: Tables):
    rows = ev.profits(t.scored)
    return rows.select(*KEY, *[rounded(F.col(c)).alias(c) for c in ("potential", "actual")])


def expected_values(t: Tables):
    rows = ev.expected(t.scored)
    return rows.select(*KEY, rounded(F.col("ep")).alias("ep"), (F.col("ep") > 0).alias("bet"))


def roc(t: Tables):
    return ev.roc_points(t.scored).select(
        "thresh", rounded(F.col("fpr")).alias("fpr"), rounded(F.col("tpr")).alias("tpr")
    )


def validation(t: Tables):
    """Live-stored against batch expected value, and what the bid made, per user."""
    checked = ev.live_check(t.scored, live_rows(t)).join(t.bids.select(*KEY, "username"), KEY)
    return checked.groupBy("username").agg(
        F.count("*").alias("n"),
        rounded(F.sum("batch_ev")).alias("batch_ev"),
        rounded(F.sum("live_ev")).alias("live_ev"),
        rounded(F.sum("actual")).alias("actual"),
    )


def next_bid_values(t: Tables):
    """Expected value of the bid after the last one, for either way of bidding."""
    last = t.bids.groupBy("auctionid").agg((F.max("bid") + 1).alias("bid"))
    rows = with_auction(last, t.auctions).select(
        *KEY, "cashvalue", scalar.fee(F.col("cardvalue")).alias("fee"),
        ((F.col("bid") * 7) % 100 / F.lit(100.0)).alias("bom_proba"),
        ((F.col("bid") * 3) % 100 / F.lit(100.0)).alias("manual_proba"),
    )
    out = ev.live_expected(rows)
    return out.select(*KEY, *[rounded(F.col(c)).alias(c) for c in ("potential_profit", "bom_ev", "manual_ev")])


QUERIES = {
    "e01_profits": priced,
    "e02_expected_value": expected_values,
    "e02_strategy_profit": lambda t: ev.strategy_profit(t.scored),
    "e03_threshold_sweep": lambda t: ev.threshold_sweep(t.scored),
    "e03_threshold_sweep_strict": lambda t: ev.threshold_sweep(t.scored, first=10, last=19, strict=True),
    "e03_sweep_winners": lambda t: ev.sweep_winners(t.scored),
    "e03_sweep_every_probability": lambda t: ev.sweep_every_probability(t.scored),
    "e03_label_above_cutoffs": lambda t: ev.label_above_cutoffs(t.scored, F.col("prob") * 100),
    "e04_ev_bins": lambda t: ev.ev_bins(t.scored),
    "e05_ev_curve": lambda t: ev.ev_curve(t.scored),
    "e06_ev_chunk_totals": lambda t: ev.chunk_totals(ev.ev_chunks(t.scored)),
    "e07_best_threshold": lambda t: ev.best_threshold(t.scored),
    "e08_roc_points": roc,
    "e08_roc_auc": lambda t: ev.roc_auc(t.scored),
    "e09_ev_confusion": lambda t: ev.ev_confusion(t.scored),
    "e10_bets_by_bid": lambda t: ev.bet_totals(t.scored, {"bid": F.col("bid")}),
    "e10_bets_by_hour": lambda t: ev.bet_totals(t.scored, {"hour": F.hour("auctiontime")}),
    "e10_bets_by_day": lambda t: ev.bet_totals(t.scored, {"day": F.dayofmonth("auctiontime")}),
    "e10_bets_by_product": lambda t: ev.bet_totals(
        t.scored, {c: F.col(c) for c in ("cardtype", "cardvalue", "bidvalue")}
    ),
    "e10_bets_of_a_type_by_outcome": lambda t: ev.bet_totals(
        t.scored.where(F.col("cardtype") == "Brand#1"), {"is_winner": F.col("is_winner")}
    ),
    "e11_daily_profit": lambda t: ev.bet_totals(t.scored, {"date": F.to_date("auctiontime").cast("string")}),
    "e12_live_validation": validation,
    "e13_next_bid_value": next_bid_values,
    "e14_predicted_rates": lambda t: ev.predicted_rates(t.scored, ["is_bidomatic"]),
}
