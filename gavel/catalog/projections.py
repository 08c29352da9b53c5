"""Filters, predicates and scalar features."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.catalog.tables import MIDWAY, Tables
from gavel.functions import scalar
from gavel.model.win_model import model_rows
from gavel.operators import exploration as x
from gavel.operators.bid_features import pending_auctions, with_auction
from gavel.operators.history import history_columns, normalised
from gavel.operators.opponents import directly_followed, opponents
from gavel.schemas import FEATURE_COLUMNS
from gavel.session import written
from gavel.sources.pages import clean_auctions
from gavel.streaming.live import board_labels, upcoming_candidates, upcoming_labels

KEY = ["auctionid", "bid"]


def upcoming_list(t: Tables):
    """One upcoming auction per part, for the watch-list queries."""
    size = F.col("p_size")
    return t.raw("part").select(
        F.col("p_partkey").cast("string").alias("auctionid"),
        F.when(size % 4 == 0, "None").when(size % 4 == 1, "Buster").otherwise(F.col("p_brand")).alias("cardtype"),
        F.when(size % 3 == 0, 0).when(size % 3 == 1, 10).otherwise(75).alias("cardvalue"),
        size.alias("bidvalue"),
        (size * 13 % 700).alias("seconds_left"),
    )


def launched(t: Tables):
    return t.auctions.where(F.col("limited_allowed")).select(F.col("qauctionid").cast("string").alias("auctionid"))


def board(t: Tables):
    """A tracking row per auction, priced with the pseudo-probability."""
    price = t.bids.groupBy("auctionid").agg(F.max("bid").alias("bid"))
    rows = with_auction(price, t.auctions).withColumn(
        "bom_proba", (F.col("auctionid") * 31 + F.col("bid") * 17) % 100 / F.lit(100.0)
    )
    profit = scalar.potential_profit(F.col("cashvalue"), scalar.fee(F.col("cardvalue")), F.col("bid"))
    return rows.select(
        F.col("auctionid").cast("string").alias("auction_id"),
        F.when(F.col("cashvalue") == 1, "None").otherwise(F.col("cardtype")).alias("cardtype"),
        "cardvalue",
        "bidvalue",
        (F.col("runtime") % 600).alias("sl"),
        profit.alias("potential_profit"),
        "bom_proba",
        scalar.expected_value(F.col("bom_proba"), profit).alias("bom_ev"),
        scalar.expected_value(F.col("bom_proba") / 2, profit).alias("manual_ev"),
        F.col("limited_allowed").alias("is_live"),
        (F.col("tracking") == 100).alias("tracking_ok"),
    )


def quality(t: Tables):
    """Every auction with whether it may be loaded."""
    kept, excluded = clean_auctions(t.auctions)
    return kept.select("qauctionid", F.lit(True).alias("kept")).unionByName(
        excluded.select(F.col("auctionid").alias("qauctionid"), F.lit(False).alias("kept"))
    )


def normalised_history(t: Tables):
    hist = history_columns(t.history)
    return hist.select(
        "auctionid", "username", "prev_auction_count", "prev_is_new_user",
        *[x.rounded(F.expr(c)).alias(n) for n, c in normalised().items()],
    )


def time_features(t: Tables):
    ts = F.col("auctiontime")
    return t.auctions.select(
        "qauctionid",
        scalar.time_of_day(ts).alias("time_of_day"),
        scalar.is_weekend(ts).alias("is_weekend"),
        scalar.fee(F.col("cardvalue")).alias("fee"),
        scalar.minute_of_day(ts).alias("minute_of_day"),
        F.dayofmonth(ts).alias("day"),
    )


def pending_report(t: Tables):
    """Auctions before the cutoff that the processed table lacks."""
    done = t.joined.where(F.col("auctiontime") < F.lit("2024-01-05").cast("timestamp_ntz")).select("auctionid")
    return pending_auctions(t.auctions, MIDWAY, done).select("qauctionid", "auctiontime")


QUERIES = {
    "f01_quality_filter": quality,
    "f02_load_projection": lambda t: clean_auctions(
        t.auctions.withColumn("lock_price", F.when(F.col("lock_price") > 0, F.col("lock_price")))
    )[0],
    "f03_is_locked": lambda t: t.joined.select(
        *KEY, scalar.is_locked(F.col("lock_price"), F.col("bid")).alias("is_locked")
    ),
    "f04_fee": lambda t: t.auctions.select("qauctionid", scalar.fee(F.col("cardvalue")).alias("fee")),
    "f05_outcome_flags": lambda t: t.transform.select(*KEY, "is_winner", "is_pen", "giveup"),
    "f06_perc_to_bin": lambda t: t.transform.select(*KEY, "perc_to_bin"),
    "f07_bom_bids_so_far": lambda t: t.transform.select(*KEY, "bom_bids_so_far"),
    "f08_pending_before_cutoff": pending_report,
    "f09_model_rows": lambda t: model_rows(
        written(t.plain.select(*KEY, "username", "auctiontime", "is_bidomatic"), "plain"), MIDWAY
    ).select(*KEY, "username"),
    "f10_time_features": time_features,
    "f11_flag_text": lambda t: t.plain.select(
        *KEY, *[scalar.flag_text(F.col(f"is_bidomatic{i}")).alias(f"is_bidomatic{i}") for i in range(4)]
    ),
    "f12_normalised_history": normalised_history,
    "f13_directly_followed": lambda t: directly_followed(
        opponents(t.transform, attributes=["username", "distance"])
    ).select(*KEY, "distance0"),
    "f14_upcoming_candidates": lambda t: upcoming_candidates(upcoming_list(t), launched(t), 350),
    "f05_older_giveup": lambda t: t.transform.select(
        *KEY, ((F.col("bid") == F.col("eventual_bids")) & ~F.col("is_winner")).alias("giveup")
    ),
    "f15_upcoming_labels": lambda t: upcoming_labels(upcoming_list(t)),
    "f15_board_labels": lambda t: board_labels(board(t)),
    "f16_giveup_by_parameter": lambda t: t.transform.where(
        (F.col("cardvalue") == 0) & F.col("bidvalue").isin(3, 5, 8, 10, 15, 25)
    ).groupBy("bidvalue", x.rounded(F.col("perc_to_bin")).alias("perc_of_bin")).agg(
        x.rate("giveup").alias("giveup_frac")
    ),
    "f16_giveup_against_parameter": lambda t: x.giveup_against_group(
        t.transform.where((F.col("cardvalue") == 0) & F.col("bidvalue").isin(3, 5, 8, 10, 15, 25)),
        "bidvalue", x.rounded(F.col("perc_to_bin")), "perc_of_bin",
    ).where((F.col("perc_of_bin") > 0) & (F.col("perc_of_bin") < 5)),
    "f17_fill_zero": lambda t: t.transform.groupBy("username").agg(
        F.count("*").alias("n"), x.rounded(F.avg(F.when(F.col("giveup"), F.col("bids_so_far")))).alias("avg_giveup")
    ).na.fill(0),
    "f18_column_contract": lambda t: t.full.drop("username0", "username1", "username2", "username3").select(
        *[c for c in FEATURE_COLUMNS if not c.startswith("username") or c == "username"]
    ),
}
