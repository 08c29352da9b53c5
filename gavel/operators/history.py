"""What each user had done before an auction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.functions.scalar import minute_of_day, perc_to_bin
from gavel.operators.blocks import WIDTH, block_of, carry_in
from gavel.session import written

# measure in the rollup -> name of its exclusive prefix sum
PREFIX_SUMS = {
    "overbid": "prev_overbid_count",
    "giveup_at_one": "prev_giveup_one_count",
    "giveup_before_six": "prev_giveup_before_six_count",
    "wins": "prev_wins_count",
    "bidomatic_bids": "prev_bom_bid_count",
    "bids": "prev_bid_count",
}
ROLLUP_COLUMNS = [
    "auctionid", "username", "auctiontime", "bids", "bidomatic_bids", "entry", "wins",
    "giveup_at_one", "giveup_before_six", "overbid",
]


def _flag(cond: Column) -> Column:
    return F.when(cond, 1.0).otherwise(0.0)


def rollup_transformed(transformed: DataFrame) -> DataFrame:
    """One row per (auction, user, end time), from per-bid features."""
    giveup, so_far = F.col("giveup"), F.col("bids_so_far")
    return (
        transformed.groupBy("auctionid", "username", "auctiontime")
        .agg(
            F.count("*").alias("bids"),
            F.sum(F.col("is_bidomatic").cast("long")).alias("bidomatic_bids"),
            F.min("bid").alias("entry"),
            F.sum(F.col("is_winner").cast("long")).alias("wins"),
            F.max(_flag(giveup & (so_far == 1))).alias("giveup_at_one"),
            F.max(_flag(giveup & (so_far <= 5))).alias("giveup_before_six"),
            F.max(_flag(F.col("perc_to_bin") >= 1)).alias("overbid"),
        )
        .select(*ROLLUP_COLUMNS)
    )


def rollup(bids: DataFrame, auctions: DataFrame) -> DataFrame:
    """The same rollup straight from the bids, without per-bid windows.

    A user gives up at their last bid unless that bid won, so counts and the
    last bid per user decide every flag; both are combined before the shuffle.
    """
    per_user = bids.groupBy("auctionid", "username").agg(
        F.count("*").alias("bids"),
        F.sum(F.col("is_bidomatic").cast("long")).alias("bidomatic_bids"),
        F.min("bid").alias("entry"),
        F.max("bid").alias("last"),
    )
    price = bids.groupBy("auctionid").agg(F.max("bid").alias("price"))
    info = auctions.select(F.col("qauctionid").alias("auctionid"), "auctiontime", "cashvalue")
    won = F.col("last") == F.col("price")
    n = F.col("bids")
    return per_user.join(info.join(price, "auctionid"), "auctionid").select(
        "auctionid",
        "username",
        "auctiontime",
        "bids",
        "bidomatic_bids",
        "entry",
        won.cast("long").alias("wins"),
        _flag(~won & (n == 1)).alias("giveup_at_one"),
        _flag(~won & (n <= 5)).alias("giveup_before_six"),
        _flag(perc_to_bin(n, F.col("cashvalue")) >= 1).alias("overbid"),
    )


def user_history(rolled: DataFrame, width: int = WIDTH) -> DataFrame:
    """Exclusive prefix sums per user over auction end times.

    Auctions that end at the same instant count each other as past (the sums
    run over peers); the auction count breaks such ties by auction id. Each
    user's day gets the carry of the earlier days, from totals that are written
    once. Unless these show a day with more than `width` auctions of one user,
    rows are shuffled once and run inside the day.
    """
    measures = [*PREFIX_SUMS, "n"]
    per_day = rolled.groupBy("username", F.to_date("auctiontime").alias("day")).agg(
        F.expr("count(*) AS n"), *[F.expr(f"sum({m}) AS {m}") for m in PREFIX_SUMS]
    )
    per_day = written(per_day, "day_totals")
    days = carry_in(per_day, ["username"], "day", {f"{m}_days": F.col(m) for m in measures})
    if not per_day.where(F.col("n") > width).isEmpty():
        return _busy_history(rolled, days)
    in_day = "PARTITION BY username, day ORDER BY auctiontime"
    upto = f"({in_day} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    rows = rolled.select("*", F.to_date("auctiontime").alias("day")).repartition("username", "day")
    ranked = rows.selectExpr("*", f"row_number() OVER ({in_day}, auctionid) - 1 AS rank_in")
    placed = ranked.selectExpr("*", *[f"sum({m}) OVER {upto} AS {m}_upto" for m in PREFIX_SUMS])
    return placed.join(days, ["username", "day"]).selectExpr(
        "auctiontime",
        "username",
        "auctionid",
        *[f"{m}_days + {m}_upto - {m} AS {name}" for m, name in PREFIX_SUMS.items()],
        "n_days + rank_in AS prev_auction_count",
    )


def _busy_history(rolled: DataFrame, days: DataFrame) -> DataFrame:
    """The same where a user's day is too much for one window.

    Rows are first summed per (user, instant, range of ids), then run inside a
    minute. Each minute gets the carry of the day's earlier minutes, and each
    day that of the user's earlier days, so a busy day of one user stays spread
    out.
    """
    ts = F.col("auctiontime")
    spread = rolled.withColumns(
        {"day": F.to_date(ts), "minute": minute_of_day(ts), "id_block": block_of(F.col("auctionid"))}
    )
    keys = ["username", "day", "minute", "auctiontime", "id_block"]
    per_instant = spread.groupBy(*keys).agg(
        F.expr("count(*) AS n"), *[F.expr(f"sum({m}) AS {m}") for m in PREFIX_SUMS]
    )
    upto = "(PARTITION BY username, day, minute ORDER BY auctiontime RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    instant = "PARTITION BY username, day, minute, auctiontime"
    lower_ids = f"({instant} ORDER BY id_block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    placed = per_instant.selectExpr(
        *keys,
        *[f"sum({m}) OVER {upto} AS {m}_upto" for m in PREFIX_SUMS],
        f"sum(n) OVER {upto} - sum(n) OVER ({instant}) + coalesce(sum(n) OVER {lower_ids}, 0) AS n_before",
    )
    measures = [*PREFIX_SUMS, "n"]
    minutes = carry_in(per_instant, ["username", "day"], "minute", {f"{m}_minutes": F.col(m) for m in measures})
    carry = minutes.join(days, ["username", "day"]).select(
        "username", "day", "minute", *[(F.col(f"{m}_minutes") + F.col(f"{m}_days")).alias(f"{m}_carry") for m in measures]
    )
    totals = placed.join(carry, ["username", "day", "minute"])
    among = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY auctionid) - 1 AS rank_in"
    return spread.selectExpr("*", among).join(totals, keys).selectExpr(
        "auctiontime",
        "username",
        "auctionid",
        *[f"{m}_carry + {m}_upto - {m} AS {name}" for m, name in PREFIX_SUMS.items()],
        "n_carry + n_before + rank_in AS prev_auction_count",
    )


def history_columns(hist: DataFrame) -> DataFrame:
    """History as the feature rows carry it: a new user counts one auction."""
    return hist.selectExpr(
        "auctionid",
        "username",
        "greatest(prev_auction_count, 1L) AS prev_auction_count",
        "CAST(prev_auction_count = 0 AS int) AS prev_is_new_user",
        "prev_overbid_count AS prev_overbid",
        "prev_giveup_one_count AS prev_giveup_one",
        "prev_giveup_before_six_count AS prev_giveup_before_six",
        "prev_wins_count AS prev_wins",
        "prev_bid_count AS prev_bids",
        "prev_bom_bid_count AS prev_bom_bids",
    )


def unify(transformed: DataFrame, hist: DataFrame) -> DataFrame:
    """Per-bid features joined with the bidder's history."""
    return transformed.join(history_columns(hist), ["auctionid", "username"])


def normalised() -> dict[str, str]:
    """History per previous auction, as SQL text by output name."""
    sources = {
        "prev_overbid": "prev_overbid",
        "prev_giveup_one": "prev_giveup_one",
        "prev_give_before_six": "prev_giveup_before_six",
        "prev_wins": "prev_wins",
        "prev_bids": "prev_bids",
        "prev_bom_bids": "prev_bom_bids",
    }
    return {out: f"CAST({name} AS double) / nullif(prev_auction_count, 0)" for out, name in sources.items()}


def user_snapshot(full: DataFrame, until: str | None = None) -> DataFrame:
    """Each bidder's history as seen in their last auction, up to a time if given.

    The values come from the row where the user is opponent 0 with one bid,
    so they describe the user before that auction, and are NULL when nobody
    else bid right after the user's first bid.
    """
    if until is not None:
        full = full.where(F.col("auctiontime") <= F.lit(until).cast("timestamp_ntz"))
    last = full.groupBy("username").agg(F.max("auctiontime").alias("max_time"))
    seen = full.where(F.col("bids_so_far0") == 1).select(
        F.col("username0").alias("username"),
        F.col("auctiontime").alias("max_time"),
        *[f"{c}0" for c in _SNAPSHOT],
    )
    return last.join(seen, ["username", "max_time"], "left").select(
        "username", *[f"{c}0" for c in _SNAPSHOT]
    )


_SNAPSHOT = [
    "prev_auction_count", "prev_overbid", "prev_giveup_one", "prev_give_before_six",
    "prev_wins", "prev_bids", "prev_bom_bids",
]


def lookup(df: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Attach one snapshot row per username; unknown users get the new-user defaults."""
    key = F.struct(*[F.coalesce(f"{c}0", F.lit(-1)) for c in _SNAPSHOT], *[f"{c}0" for c in _SNAPSHOT])
    one = snapshot.groupBy("username").agg(F.min(key).alias("k"), F.lit(1).alias("known"))
    one = one.select(
        "username", "known", *[F.col("k")[f"{c}0"].alias(c) for c in _SNAPSHOT]
    )
    joined = df.join(one, "username", "left")
    known = F.col("known").isNotNull()
    return joined.select(
        *df.columns,
        F.when(known, 0).otherwise(1).alias("prev_is_new_user"),
        F.when(known, F.col("prev_auction_count")).otherwise(1).alias("prev_auction_count"),
        *[F.when(known, F.col(c)).otherwise(0.0).alias(c) for c in _SNAPSHOT[1:]],
    )
