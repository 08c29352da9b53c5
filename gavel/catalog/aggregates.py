"""Group-bys, rates and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.catalog.tables import Tables
from gavel.functions import scalar
from gavel.operators import evaluation as ev
from gavel.operators import exploration as x
from gavel.operators import history as h
from gavel.operators.bid_features import with_auction
from gavel.operators.opponents import opponent_runs
from gavel.sources import derived

KEY = ["auctionid", "bid"]


def density_by_outcome(t: Tables):
    """Share of the price the nearest opponent spent, winners against losers."""
    share = scalar.perc_to_bin(F.col("bids_so_far0"), F.col("cashvalue"))
    counts = x.histogram(t.plain.withColumn("share", share), F.col("share"), 1 / 16, ["is_winner"])
    return x.density(counts, ["is_winner"], 1 / 16)


def streaks_by_outcome(t: Tables):
    """Streaks of the nearest opponent where that is a bidomatic, winners against losers."""
    rows = t.plain.where("is_bidomatic0")
    return x.histogram(rows, F.col("bom_streak0"), 2.0, ["is_winner"])


def bid_density_by_outcome(t: Tables):
    return x.density(x.histogram(t.scored, F.col("bid"), 4.0, ["is_winner"]), ["is_winner"], 4.0)


def values_of_bets(t: Tables):
    """Expected values of the bets worth placing, in bins of a sixteenth."""
    return x.histogram(ev.expected(t.scored).where(F.col("ep") > 0.1), F.col("ep"), 1 / 16)


def log_bids_per_user(t: Tables):
    """Users by bid count in bins of 50, split at a count of 200."""
    counts = x.bids_per_user(t.bids)
    many = F.col("my_count") > 200
    return counts.groupBy(many.alias("many"), F.expr("my_count div 50").alias("bin")).agg(
        F.count("*").alias("users"), x.rounded(F.log10(F.count("*"))).alias("log_users")
    )


def win_rate_per_cluster_hour(t: Tables):
    rows = t.transform.withColumn("hour", F.hour("auctiontime"))
    return x.group_means(rows, ["hour"], ["is_winner", "perc_to_bin", "bid"])


def lowest_bids(t: Tables):
    """Mean expected and actual profit for the thirty lowest bids; halves of the last digit go up."""
    tie = F.lit(1e-9)
    return (
        ev.expected(t.scored)
        .groupBy("bid")
        .agg(x.rounded(F.avg("ep") + tie).alias("avg_ep"), x.rounded(F.avg("actual") + tie).alias("avg_actual"))
        .orderBy("bid")
        .limit(30)
    )


def overall_giveup_by_share(t: Tables):
    share = F.round(F.col("perc_to_bin") * 100, 6)
    near = t.transform.where(F.col("perc_to_bin").isNotNull())
    return x.giveup_against_overall(near, share, "perc_of_bin").where(
        (F.col("perc_of_bin") > 0) & (F.col("perc_of_bin") < 100)
    )


def giveup_by_streak(t: Tables):
    """Give-up rate of bidomatic bids by streak, against all bids."""
    overall = t.transform.select(F.avg(F.col("giveup").cast("int"))).scalar()
    return (
        t.transform.where(F.col("is_bidomatic") & (F.col("bom_streak") < 200))
        .groupBy("bom_streak")
        .agg(x.rate("giveup").alias("giveup_frac"))
        .select("bom_streak", x.rounded(overall).alias("avg_giveup"), "giveup_frac")
    )


def outcome_counts(t: Tables):
    return x.overall_counts(t.plain).select(
        "n", "winners", "win_rate", "limited_rate", "winners_one_opponent"
    )


def ungrouped_rates(t: Tables):
    """Give-up rate by bid type next to the win rate of all bids."""
    baseline = t.transform.select(F.avg(F.col("is_winner").cast("int"))).scalar()
    return (
        t.transform.groupBy("is_bidomatic")
        .agg(x.rate("giveup").alias("giveup_rate"), F.count("*").alias("n"))
        .select("is_bidomatic", "giveup_rate", "n", x.rounded(baseline).alias("win_rate"))
    )


def prob_counts(t: Tables):
    counts = x.value_counts(t.scored, "prob")
    return counts.select("prob", "n", counts.select(F.count("*")).scalar().alias("distinct_probs"))


def hourly_auctions(t: Tables):
    return t.auctions.groupBy(F.hour("auctiontime").alias("my_hour")).agg(F.count("*").alias("c"))


def latest_opponent_bids(t: Tables):
    """Last bid of each opponent anybody in the auction has seen."""
    return opponent_runs(t.bids).groupBy("auctionid", "p_username").agg(
        F.max("max_bid").alias("max_bid"), F.sum("times_seen").alias("times_seen")
    )


QUERIES = {
    "a01_auction_user_rollup": lambda t: h.rollup(t.bids, t.auctions),
    "a01_rollup_from_features": lambda t: h.rollup_transformed(t.transform),
    "a02_latest_opponent_bid": latest_opponent_bids,
    "a03_last_time_per_user": lambda t: t.joined.groupBy("username").agg(F.max("auctiontime").alias("max_auctiontime")),
    "a04_bids_per_user": lambda t: x.bids_per_user(t.bids),
    "a05_giveup_profile": lambda t: x.giveup_profile(t.transform),
    "a06_entry_profile": lambda t: x.entry_profile(t.transform),
    "a07_win_profile": lambda t: x.win_profile(t.transform),
    "a08_giveup_by_streak": giveup_by_streak,
    "a08_giveup_by_share": overall_giveup_by_share,
    "a09_means_by_opponent_bids": lambda t: x.group_means(
        t.plain, ["bids_so_far0"], ["is_winner", "giveup", "cashvalue", "bid"]
    ),
    "a09_means_by_opponent_types": lambda t: x.group_means(
        t.plain, ["is_bidomatic0", "is_bidomatic1"], ["is_winner", "prevusers", "bids_so_far"]
    ),
    "a09_near_price": lambda t: x.near_price(t.plain),
    "a09_means_by_hour": win_rate_per_cluster_hour,
    "a09_means_by_time": lambda t: x.group_means(t.transform, ["auctiontime"], ["limited_allowed", "is_winner"]),
    "a09_lowest_bids": lowest_bids,
    "a09_means_by_cardvalue": lambda t: x.group_means(t.transform, ["cardvalue"], ["is_winner", "bid", "fee"]),
    "a10_product_counts": lambda t: x.product_counts(t.transform),
    "a10_product_profit": lambda t: ev.bet_totals(
        t.scored, {c: F.col(c) for c in [*x.PRODUCT, "limited_allowed"]}
    ),
    "a11_conditional_rates": ungrouped_rates,
    "a12_win_rate_by_streak": lambda t: x.streak_win_rate(t.plain, []),
    "a12_win_rate_by_streak_product": lambda t: x.streak_win_rate(t.plain, x.PRODUCT),
    "a13_win_rate_by_cashvalue": lambda t: x.win_rate_by_opponent_bids(t.plain, [1, 2, 3, 4]),
    "a14_auctions_per_hour": hourly_auctions,
    "a15_bucket_means": lambda t: x.bucket_means(t.transform),
    "a16_giveup_histogram": lambda t: x.histogram(
        t.transform.where((F.col("perc_to_bin") > 0.1) & (F.col("perc_to_bin") < 1)),
        F.col("perc_to_bin"), 1 / 32, ["giveup"],
    ),
    "a16_density_by_outcome": density_by_outcome,
    "a16_winning_bids_by_product": lambda t: x.histogram(
        with_auction(t.bids.groupBy("auctionid").agg(F.max("bid").alias("bid")), t.auctions),
        F.col("bid"), 2.0, x.PRODUCT,
    ),
    "a16_streaks_by_outcome": streaks_by_outcome,
    "a16_bid_density_by_outcome": bid_density_by_outcome,
    "a16_winners_bids_by_product": lambda t: x.winning_bids_by_product(t.transform),
    "a16_values_of_bets": values_of_bets,
    "a16_log_bids_per_user": log_bids_per_user,
    "a17_probability_counts": prob_counts,
    "a18_overall_counts": outcome_counts,
    "a19_distinct_keys": lambda t: derived.bids(t.spark, t.sf_dir).select("auctionid").distinct(),
}
