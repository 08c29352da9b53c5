"""Per-bid features inside one auction.

Everything is computed after a single exchange by (auctionid, block), where a
block is a fixed range of bid numbers. Short auctions have one block. For a
long auction each block also needs its carry-in: per user the bids already
made, per user island the rows already in it, per auction the users already
seen. Those arrive as extra rows in the same exchange and are picked up by the
windows, so the bid rows are never shuffled again by a wider key and no task
ever holds more than one block of an auction.

When a filtered probe finds no bid beyond the first block, the carry branches
are left out of the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavel.functions import scalar
from gavel.operators.blocks import WIDTH, block_of, carry_in, running
from gavel.session import written

AUCTION_COLUMNS = [
    "cashvalue", "cardvalue", "auctiontime", "bidvalue", "cardtype", "limited_allowed", "lock_price",
]
TRANSFORM_COLUMNS = [
    "auctionid", *AUCTION_COLUMNS[:-1], "bid", "username", "is_bidomatic", "is_locked",
    "eventual_win_price", "bids_so_far", "eventual_bids", "bids_of_this_type", "prestreak",
    "debut", "fee", "bom_streak", "prevusers", "is_winner", "is_pen", "giveup",
    "bom_bids_so_far", "perc_to_bin",
]


def pending_auctions(
    auctions: DataFrame, cutoff: Column | str | None = None, done: DataFrame | None = None
) -> DataFrame:
    """Auctions that ended before the cutoff and are not processed yet."""
    out = auctions
    if cutoff is not None:
        at = cutoff if isinstance(cutoff, Column) else F.lit(cutoff).cast("timestamp_ntz")
        out = out.where(F.col("auctiontime") < at)
    if done is not None:
        ids = done.select(F.col("auctionid").alias("qauctionid")).distinct()
        out = out.join(ids, "qauctionid", "left_anti")
    return out


def with_auction(bids: DataFrame, auctions: DataFrame) -> DataFrame:
    """Bids with their auction's columns; orphan bids drop out."""
    return bids.join(auctions.withColumnRenamed("qauctionid", "auctionid"), "auctionid")


def long_auctions(bids: DataFrame, width: int = WIDTH) -> DataFrame:
    """Auctions with more than one block. The filter reaches the scan, so row
    groups without high bid numbers are skipped."""
    return bids.where(F.col("bid") >= width).groupBy("auctionid").agg(F.max("bid").alias("last_bid"))


def has_long(bids: DataFrame, width: int = WIDTH) -> bool:
    """Whether any auction needs a second block; stops at the first hit."""
    return not bids.where(F.col("bid") >= width).select("auctionid").limit(1).isEmpty()


def _user_blocks(bids: DataFrame, long: DataFrame, width: int) -> DataFrame:
    """Long auctions only: bids and bidomatic bids per (auction, user, block)."""
    return (
        bids.join(long, "auctionid", "left_semi")
        .withColumn("block", block_of(F.col("bid"), width))
        .groupBy("auctionid", "username", "block")
        .agg(F.count("*").alias("n"), F.sum(F.col("is_bidomatic").cast("long")).alias("n_bom"))
    )


def _user_carry(blocks: DataFrame) -> DataFrame:
    """Carry-in per (auction, user, block), and the user's final bid count."""
    group = Window.partitionBy("auctionid", "username")
    earlier = group.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        "auctionid",
        "username",
        "block",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("prior_n"),
        F.coalesce(F.sum("n_bom").over(earlier), F.lit(0)).alias("prior_bom"),
        F.sum("n").over(group).alias("user_total"),
    )


def _auction_blocks(attributes: DataFrame, long: DataFrame, blocks: DataFrame, width: int) -> DataFrame:
    """Auction columns once per block, with the users seen in earlier blocks.

    Joining bids on (auctionid, block) rather than on auctionid keeps a hot
    auction spread over as many tasks as it has blocks.
    """
    debuts = (
        blocks.groupBy("auctionid", "username")
        .agg(F.min("block").alias("block"))
        .groupBy("auctionid", "block")
        .agg(F.count("*").alias("debuts"))
    )
    last_block = F.coalesce(block_of(F.col("last_bid"), width), F.lit(0).cast("long"))
    spread = (
        attributes
        .join(long, "auctionid", "left")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last_block)))
    )
    earlier = (
        Window.partitionBy("auctionid").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    grid = long.select(
        "auctionid",
        F.explode(F.sequence(F.lit(0).cast("long"), block_of(F.col("last_bid"), width))).alias("block"),
    )
    seen = grid.join(debuts, ["auctionid", "block"], "left").select(
        "auctionid", "block", F.sum("debuts").over(earlier).alias("prior_users")
    )
    return spread.join(seen, ["auctionid", "block"], "left")


def _side_rows(df: DataFrame, **cols: Column) -> DataFrame:
    """Carry rows shaped like bid rows: no bid number, only what they bring."""
    return df.select("auctionid", "block", "username", *[c.alias(n) for n, c in cols.items()])


def _counted(rows: DataFrame) -> DataFrame:
    """Running counts per user, from the rows of one block and its carry rows."""
    user = Window.partitionBy("auctionid", "block", "username").orderBy("bid")
    upto = user.rowsBetween(Window.unboundedPreceding, 0)
    whole = user.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    carried = "prior_n" in rows.columns
    brought = ["history"] if "history" in rows.columns else []

    def carry(name: str) -> Column:
        return F.coalesce(F.max(name).over(whole), zero) if carried else zero

    is_bom = F.when(F.col("bid").isNotNull() & F.col("is_bidomatic"), 1).otherwise(0)
    total = F.count("bid").over(whole)
    counted = rows.select(
        *rows.columns[: rows.columns.index("is_bidomatic") + 1],
        *(["prestreak", "run_carry"] if carried else []),
        (carry("prior_n") + F.count("bid").over(upto)).alias("n"),
        (carry("prior_bom") + F.sum(is_bom).over(upto)).alias("bom"),
        (F.coalesce(F.max("user_total").over(whole), total) if carried else total).alias("eventual_bids"),
        *[F.first(c, ignorenulls=True).over(whole).alias(c) for c in brought],
    )
    is_bid = F.col("bid").isNotNull()
    if carried:
        counted = counted.where(is_bid | F.col("run_carry").isNotNull())
    elif brought:
        counted = counted.where(is_bid)
    same = F.when(F.col("is_bidomatic"), F.col("bom")).otherwise(F.col("n") - F.col("bom"))
    offset = F.col("n") - same
    return counted.select(
        "auctionid",
        "block",
        "username",
        "bid",
        "is_bidomatic",
        *(["run_carry"] if carried else []),
        F.col("n").alias("bids_so_far"),
        same.alias("bids_of_this_type"),
        "eventual_bids",
        (F.when(is_bid, offset).otherwise(F.col("prestreak")) if carried else offset).alias("prestreak"),
        *brought,
    )


def _bid_rows(bids: DataFrame, width: int, carried: bool) -> DataFrame:
    none = F.lit(None).cast("long")
    carry = ("prior_n", "prior_bom", "user_total", "prestreak", "run_carry") if carried else ()
    return bids.select(
        "auctionid",
        block_of(F.col("bid"), width).alias("block"),
        "username",
        "bid",
        "is_bidomatic",
        *[none.alias(c) for c in carry],
    )


def _run_carry(bids: DataFrame, long: DataFrame, carry: DataFrame, width: int, strict: bool) -> DataFrame:
    """Rows already in each island before a block, where there are any."""
    rows = _bid_rows(bids.join(long, "auctionid", "left_semi"), width, True)
    rows = rows.unionByName(carry, allowMissingColumns=True)
    counted = _counted(rows.repartition("auctionid", "block"))
    keys = ["auctionid", "username", "prestreak"] + (["is_bidomatic"] if strict else [])
    runs = carry_in(counted, keys, "block", {"run_carry": F.lit(1)})
    return runs.where(F.col("run_carry") > 0)


def bid_transform(
    bids: DataFrame,
    auctions: DataFrame,
    cutoff: Column | str | None = None,
    done: DataFrame | None = None,
    strict_islands: bool = False,
    history: DataFrame | None = None,
    width: int = WIDTH,
    long_bids: bool | None = None,
    keep_block: bool = False,
    any_type_streak: bool = False,
) -> DataFrame:
    """One row per bid of the pending auctions, with its running features.

    `history`, keyed by (auctionid, username), is attached on the way as a
    struct column of that name without another shuffle of the bids.
    `strict_islands` restarts the streak at every change of bid type; without
    it islands that share an offset are numbered as one, as the batch SQL does.
    `any_type_streak` numbers the islands of manual bids too, instead of 0.
    `long_bids` says whether any auction has more than `width` bids; None probes.
    """
    live = pending_auctions(auctions, cutoff, done)
    if cutoff is not None or done is not None:
        ids = live.select(F.col("qauctionid").alias("auctionid"))
        bids = bids.join(ids, "auctionid", "left_semi")
    bids = bids.select("auctionid", "bid", "username", "is_bidomatic")
    carried = has_long(bids, width) if long_bids is None else long_bids

    attributes = live.select(F.col("qauctionid").alias("auctionid"), *AUCTION_COLUMNS)
    rows = _bid_rows(bids, width, carried)
    if carried:
        long = long_auctions(bids, width)
        user_blocks = _user_blocks(bids, long, width)
        prior = _user_carry(user_blocks)
        carry = _side_rows(prior, **{c: F.col(c) for c in ("prior_n", "prior_bom", "user_total")})
        runs = _run_carry(bids, long, carry, width, strict_islands)
        given = ["prestreak", "run_carry"] + (["is_bidomatic"] if strict_islands else [])
        run_rows = _side_rows(runs, **{c: F.col(c) for c in given})
        rows = rows.unionByName(carry, allowMissingColumns=True)
        rows = rows.unionByName(run_rows, allowMissingColumns=True)
        attributes = _auction_blocks(attributes, long, user_blocks, width)
    if history is not None:
        first_block = F.lit(0).cast("long")
        if carried:
            blocks = prior.select("auctionid", "username", "block")
            placed = history.join(blocks, ["auctionid", "username"], "left")
            placed = placed.withColumn("block", F.coalesce("block", first_block))
        else:
            placed = history.withColumn("block", first_block)
        brought = [c for c in history.columns if c not in ("auctionid", "username")]
        placed = _side_rows(placed, history=F.struct(*brought))
        rows = rows.unionByName(placed, allowMissingColumns=True)
    # Without long auctions every block is block 0 and the auction alone spreads.
    spread_by = ["auctionid", "block"] if carried else ["auctionid"]
    counted = _counted(rows.repartition(*spread_by))

    island = ["auctionid", "block", "username", "prestreak"] + (["is_bidomatic"] if strict_islands else [])
    run = Window.partitionBy(*island).orderBy("bid")
    in_run = F.count("bid").over(run.rowsBetween(Window.unboundedPreceding, 0))
    if carried:
        whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        in_run = in_run + F.coalesce(F.max("run_carry").over(whole), F.lit(0))
    streaked = counted.withColumn("in_run", in_run)
    if carried:
        streaked = streaked.where(F.col("bid").isNotNull())

    joined = streaked.join(attributes, spread_by)
    order = Window.partitionBy("auctionid", "block").orderBy("bid")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    all_of = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    debut = (F.col("bids_so_far") == 1).cast("int")
    price = F.max("bid").over(all_of)
    users = F.sum(debut).over(so_far) - 1
    base = joined.select(
        "*",
        debut.alias("debut"),
        (F.coalesce("last_bid", price) if carried else price).alias("eventual_win_price"),
        (F.coalesce("prior_users", F.lit(0)) + users if carried else users).alias("prevusers"),
    )
    bid, price = F.col("bid"), F.col("eventual_win_price")
    so_far, same = F.col("bids_so_far"), F.col("bids_of_this_type")
    out = base.select(
        "*",
        scalar.is_locked(F.col("lock_price"), bid).alias("is_locked"),
        scalar.fee(F.col("cardvalue")).alias("fee"),
        F.when(F.lit(any_type_streak) | F.col("is_bidomatic"), F.col("in_run")).otherwise(F.lit(0)).alias("bom_streak"),
        (bid == price).alias("is_winner"),
        (bid == price - 1).alias("is_pen"),
        ((so_far == F.col("eventual_bids")) & (bid != price)).alias("giveup"),
        F.when(F.col("is_bidomatic"), same).otherwise(so_far - same).alias("bom_bids_so_far"),
        scalar.perc_to_bin(so_far, F.col("cashvalue")).alias("perc_to_bin"),
    )
    extra = ["history"] if history is not None else []
    if keep_block:
        extra += ["block"] + (["last_bid"] if carried else [])
    return out.select(*TRANSFORM_COLUMNS, *extra)


def with_prev_win_bids(transformed: DataFrame) -> DataFrame:
    """Add `prev_win_bids`: what the user won in the auction before this one.

    In the user's order by (auctiontime, bid, auctionid), going back by the bids
    made so far in this auction reaches the last bid of the earlier end time;
    its voucher value counts if that bid won. So the value belongs to the user
    and end time, and comes from one row per (auction, user).

    Only when several of a user's auctions end at one instant do their bids
    interleave; those rows alone are ranked and looked up bid by bid.
    """
    worth = F.when(F.col("is_winner"), F.col("bidvalue")).otherwise(F.lit(0))
    last_bids = written(
        transformed.groupBy("auctionid", "username", "auctiontime").agg(
            F.max("bid").alias("last"), F.max_by(worth, "bid").alias("worth")
        ),
        "last_bids",
    )
    ts = F.col("auctiontime")
    placed = last_bids.withColumns({"day": F.to_date(ts), "minute": scalar.minute_of_day(ts)})
    per_time = placed.groupBy("username", "day", "minute", "auctiontime").agg(
        F.count("*").alias("n_auctions"), F.max_by("worth", F.struct("last", "auctionid")).alias("worth")
    )
    # The time before is looked for in the same minute, else in the day's minute before, else in the user's day before.
    in_minute = Window.partitionBy("username", "day", "minute").orderBy("auctiontime")
    in_day = Window.partitionBy("username", "day").orderBy("minute")
    by_day = Window.partitionBy("username").orderBy("day")
    latest = F.max_by("worth", "auctiontime")
    minute_before = per_time.groupBy("username", "day", "minute").agg(latest.alias("minute_worth")).select(
        "username", "day", "minute", F.lag("minute_worth").over(in_day).alias("minute_before")
    )
    day_before = per_time.groupBy("username", "day").agg(latest.alias("day_worth")).select(
        "username", "day", F.lag("day_worth").over(by_day).alias("day_before")
    )
    carry = minute_before.join(day_before, ["username", "day"])
    before = per_time.select("*", F.lag("worth").over(in_minute).alias("earlier")).join(carry, ["username", "day", "minute"])
    before = before.select(
        "username",
        "auctiontime",
        (F.col("n_auctions") > 1).alias("_tied"),
        F.coalesce("earlier", "minute_before", "day_before", F.lit(0)).alias("_before"),
    )
    known = last_bids.select("auctionid", "username", "auctiontime").join(before, ["username", "auctiontime"])
    rows = transformed.join(known.drop("auctiontime"), ["auctionid", "username"])
    alone = rows.where(~F.col("_tied")).select(*transformed.columns, F.col("_before").alias("prev_win_bids"))
    if known.where("_tied").limit(1).isEmpty():
        return alone
    ranked = (
        rows.where("_tied")
        .withColumns(
            {"_bids": block_of(F.col("bid")), "_bid": F.col("bid"), "_ids": block_of(F.col("auctionid"))}
        )
    )
    ranked = running(
        ranked, ["username", "auctiontime"], ["_bids", "_bid", "_ids"], ["auctionid"], {"_rank": F.lit(1)}
    ).withColumn("_back", F.col("_rank") - F.col("bids_so_far"))
    reached = ranked.select("username", "auctiontime", F.col("_rank").alias("_back"), worth.alias("_worth"))
    mixed = ranked.join(reached, ["username", "auctiontime", "_back"], "left").select(
        *transformed.columns,
        F.when(F.col("_back") == 0, F.col("_before")).otherwise(F.col("_worth")).alias("prev_win_bids"),
    )
    return alone.unionByName(mixed)
