"""The most recent distinct opponents of every bid, in linear time.

Walking an auction in bid order, keep the list of users by recency. After bid
p the list starts with p's user, and position j is taken over from position
j-1 exactly when p's user was not among the first j entries before p;
otherwise position j is unchanged. So each position is a "last value" window
over the bids at which it changed, and k positions need k windows on one sort:
no pairs of bids, no aggregate, no lookup join. The opponents of bid p are the
positions after its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavel.operators import history as h
from gavel.operators.bid_features import bid_transform, has_long, long_auctions, pending_auctions
from gavel.operators.blocks import WIDTH, block_of, running
from gavel.schemas import BASE_COLUMNS, FEATURE_COLUMNS, OPPONENT_COLUMNS, OPPONENTS
from gavel.session import written


def _chain(rows: DataFrame, keys: list[str], k: int, seeds: list[str] | None) -> DataFrame:
    """Add `_d1`..`_dk`: the latest entries of the k most recent other users.

    `_pj` is position j of the list just before the bid.
    """
    order = f"PARTITION BY {', '.join(keys)} ORDER BY bid"
    before = f"({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

    def seeded(text: str, j: int) -> str:
        return f"coalesce({text}, {seeds[j]}) AS _p{j}" if seeds else f"{text} AS _p{j}"

    def absent(j: int) -> str:
        return " AND ".join(f"NOT username <=> _p{i}.username" for i in range(j))

    out = rows.selectExpr("*", seeded(f"lag(_e, 1) OVER ({order})", 0))
    for j in range(1, k + 1):
        kept = f"last(CASE WHEN {absent(j)} THEN _p{j - 1} END, true) OVER {before}"
        out = out.selectExpr("*", seeded(kept, j))
    return out.selectExpr(
        "*", *[f"CASE WHEN {absent(j)} THEN _p{j - 1} ELSE _p{j} END AS _d{j}" for j in range(1, k + 1)]
    )


def _block_seeds(rows: DataFrame, k: int) -> DataFrame:
    """The recency list at the start of each block after an auction's first.

    Only a block's k+1 latest users can be in the list at its end, so the
    lists are chained over those few rows per block.
    """
    user = Window.partitionBy("auctionid", "block", "username").orderBy(F.desc("bid"))
    block = Window.partitionBy("auctionid", "block").orderBy(F.desc("bid"))
    few = (
        rows.withColumn("_u", F.row_number().over(user))
        .where(F.col("_u") == 1)
        .withColumn("_b", F.row_number().over(block))
        .where(F.col("_b") <= k + 1)
        .select("auctionid", "block", "username", "bid", "_b", "_e")
    )
    chained = _chain(few, ["auctionid"], k, None)
    by_block = Window.partitionBy("auctionid").orderBy("block")
    ends = chained.where(F.col("_b") == 1)
    lists = ["_e"] + [f"_d{j}" for j in range(1, k + 1)]
    return ends.select(
        "auctionid",
        "block",
        *[F.lag(c, 1).over(by_block).alias(f"_s{j}") for j, c in enumerate(lists)],
    )


def recent_users(
    rows: DataFrame, entry: list[str], k: int, width: int = WIDTH, long_bids: bool | None = None
) -> DataFrame:
    """`rows` plus `_d1`..`_dk`, structs of `entry` for the k latest other users.

    `rows` is keyed by (auctionid, bid) and `entry` (SQL select items) must
    hold username and bid. Rows that already carry `block` are taken as spread
    by (auctionid, block).
    """
    carried = has_long(rows, width) if long_bids is None else long_bids
    spread = rows
    if "block" not in rows.columns:
        by = ["auctionid", "block"] if carried else ["auctionid"]
        spread = rows.withColumn("block", block_of(F.col("bid"), width)).repartition(*by)
    spread = spread.selectExpr("*", f"struct({', '.join(entry)}) AS _e")
    if not carried:
        return _chain(spread, ["auctionid", "block"], k, None)
    seeds = _block_seeds(spread.join(long_auctions(rows, width), "auctionid", "left_semi"), k)
    joined = spread.join(seeds, ["auctionid", "block"], "left")
    return _chain(joined, ["auctionid", "block"], k, [f"_s{j}" for j in range(k + 1)])


def opponent_entry(attributes: list[str]) -> list[str]:
    """What a bid hands on to those who see its user as an opponent."""
    history = h.normalised()
    needed = ["bid"] + [c for c in attributes if c != "distance"]
    if "username" not in needed:
        needed.append("username")
    return [f"{history[c]} AS {c}" if c in history else c for c in needed]


def opponents(
    unified: DataFrame,
    k: int = OPPONENTS,
    width: int = WIDTH,
    long_bids: bool | None = None,
    attributes: list[str] = OPPONENT_COLUMNS,
) -> DataFrame:
    """Base columns plus the given attributes of each of the k latest opponents."""
    chained = recent_users(unified, opponent_entry(attributes), k, width, long_bids)
    wide = [
        f"bid - _d{i + 1}.bid AS distance{i}" if name == "distance" else f"_d{i + 1}.{name} AS {name}{i}"
        for i in range(k)
        for name in attributes
    ]
    return chained.selectExpr(*BASE_COLUMNS, *wide)


def opponent_pairs(rows: DataFrame, k: int = OPPONENTS, width: int = WIDTH) -> DataFrame:
    """Long form: (auctionid, bid, p_username, max_bid, position) for the k latest."""
    chained = recent_users(rows, ["bid", "username"], k, width)
    entries = F.array(*[F.col(f"_d{i + 1}") for i in range(k)])
    return chained.select("auctionid", "bid", F.posexplode(entries).alias("position", "e")).where(
        F.col("e").isNotNull()
    ).select(
        "auctionid",
        "bid",
        F.col("e.username").alias("p_username"),
        F.col("e.bid").alias("max_bid"),
        "position",
    )


def directly_followed(wide: DataFrame) -> DataFrame:
    """Keep bids that answer another user directly, or have no opponent yet."""
    return wide.where(F.col("distance0").isNull() | (F.col("distance0") == 1))


def auction_full(
    bids: DataFrame,
    auctions: DataFrame,
    cutoff: Column | str | None = None,
    done: DataFrame | None = None,
    strict_islands: bool = False,
    width: int = WIDTH,
) -> DataFrame:
    """The 82-column feature table for the pending auctions.

    History covers every auction before the cutoff, processed or not. Its
    rollup, one row per auction and user, is written to a working table first:
    the prefix sums need it three times and would scan the bids as often.
    """
    long_bids = has_long(bids, width)
    known = pending_auctions(auctions, cutoff)
    hist = h.user_history(written(h.rollup(bids, known), "rollup"))
    if done is not None:
        live = pending_auctions(auctions, cutoff, done).select(F.col("qauctionid").alias("auctionid"))
        hist = hist.join(live, "auctionid", "left_semi")
    return full_rows(bids, auctions, hist, cutoff, done, strict_islands, width, long_bids)


def full_rows(
    bids: DataFrame,
    auctions: DataFrame,
    hist: DataFrame,
    cutoff: Column | str | None = None,
    done: DataFrame | None = None,
    strict_islands: bool = False,
    width: int = WIDTH,
    long_bids: bool | None = None,
) -> DataFrame:
    """The feature table with the given user history, in one exchange of the narrow bids."""
    long_bids = has_long(bids, width) if long_bids is None else long_bids
    transformed = bid_transform(
        bids,
        auctions,
        cutoff,
        done,
        strict_islands,
        history=h.history_columns(hist),
        width=width,
        long_bids=long_bids,
        keep_block=True,
    )
    unified = transformed.select(
        *[c for c in transformed.columns if c not in ("history", "last_bid")], "history.*"
    )
    return directly_followed(opponents(unified, width=width, long_bids=long_bids)).select(*FEATURE_COLUMNS)


def auction_plain(
    bids: DataFrame, auctions: DataFrame, width: int = WIDTH, attributes: list[str] = OPPONENT_COLUMNS[:7]
) -> DataFrame:
    """The feature rows without user history, for queries that need none."""
    long_bids = has_long(bids, width)
    transformed = bid_transform(bids, auctions, width=width, long_bids=long_bids, keep_block=True)
    return directly_followed(
        opponents(transformed.drop("last_bid"), width=width, long_bids=long_bids, attributes=attributes)
    )


def opponent_runs(bids: DataFrame, width: int = WIDTH) -> DataFrame:
    """(auctionid, p_username, max_bid, first, last, times_seen): for which later
    bids, from first to last, a bid is the latest of its user, and how many these are.

    One row a bid at most, so linear in the bids, where the expanded list is not.
    A bid of the user's own ends the run. A user's next bid is looked for in the
    block and then in the user's next block, so a hot auction stays spread out.
    """
    rows = bids.select("auctionid", "bid", "username", block_of(F.col("bid"), width).alias("block"))
    placed = running(rows, ["auctionid"], ["block"], ["bid"], {"pos": F.lit(1)})
    at = F.struct("bid", "pos")
    by_block = Window.partitionBy("auctionid", "username").orderBy("block")
    onward = placed.groupBy("auctionid", "username", "block").agg(F.min(at).alias("lo")).select(
        "auctionid", "username", "block", F.lead("lo").over(by_block).alias("next_lo")
    )
    inside = Window.partitionBy("auctionid", "username", "block").orderBy("bid")
    followed = placed.withColumn("next", F.lead(at).over(inside)).join(onward, ["auctionid", "username", "block"])
    followed = followed.withColumn("next", F.coalesce("next", "next_lo"))
    ends = bids.groupBy("auctionid").agg(F.max("bid").alias("top"), F.count("*").alias("n"))
    runs = followed.join(ends, "auctionid").select(
        "auctionid",
        F.col("username").alias("p_username"),
        F.col("bid").alias("max_bid"),
        (F.col("bid") + 1).alias("first"),
        F.coalesce(F.col("next.bid") - 1, "top").alias("last"),
        (F.coalesce(F.col("next.pos") - 1, "n") - F.col("pos")).alias("times_seen"),
    )
    return runs.where("times_seen > 0")


def opponents_at(runs: DataFrame, auctionid: int, bid: int) -> DataFrame:
    """The opponents of one bid, out of the runs."""
    return runs.where((F.col("auctionid") == auctionid) & F.lit(bid).between(F.col("first"), F.col("last"))).select(
        "auctionid", F.lit(bid).alias("bid"), "p_username", "max_bid"
    )


def every_opponent(bids: DataFrame, width: int = WIDTH) -> DataFrame:
    """(auctionid, bid, p_username, max_bid): the latest earlier bid of every
    other user, one row per bid and opponent.

    A bid is its user's latest until the user's next bid, so each bid names the
    later bid numbers it answers for; no two bids are compared. Ranges are cut
    at block borders and handed on from block to block, so neither a long range
    nor a hot auction lands in one task. The result holds as many rows as there
    are opponents; the feature table needs only the nearest and uses the chain.
    """
    placed = bids.select("auctionid", "bid", "username", block_of(F.col("bid"), width).alias("block"))
    end_of = ((F.col("block") + 1) * width - 1).cast("int")
    inside = Window.partitionBy("auctionid", "block", "username").orderBy("bid")
    local = placed.select(
        "auctionid",
        "username",
        "block",
        F.col("bid").alias("max_bid"),
        (F.col("bid") + 1).alias("first"),
        F.coalesce(F.lead("bid").over(inside) - 1, end_of).alias("last"),
    )
    per_block = placed.groupBy("auctionid", "username", "block").agg(
        F.min("bid").alias("lo"), F.max("bid").alias("hi")
    )
    ends = placed.groupBy("auctionid").agg(F.max("block").alias("end_block"))
    by_block = Window.partitionBy("auctionid", "username").orderBy("block")
    onward = (
        per_block.withColumns({"next_block": F.lead("block").over(by_block), "next_lo": F.lead("lo").over(by_block)})
        .join(ends, "auctionid")
        .withColumn("until", F.coalesce("next_block", "end_block"))
        .where(F.col("until") > F.col("block"))
        .select(
            "auctionid", "username", F.col("hi").alias("max_bid"), "next_block", "next_lo",
            F.explode(F.sequence(F.col("block") + 1, F.col("until"))).alias("block"),
        )
        .select(
            "auctionid",
            "username",
            "block",
            "max_bid",
            (F.col("block") * width).cast("int").alias("first"),
            F.when(F.col("block") == F.col("next_block"), F.col("next_lo") - 1).otherwise(end_of).alias("last"),
        )
    )
    known = placed.groupBy("auctionid", "block").agg(F.max("bid").alias("top"))
    ranges = (
        local.unionByName(onward)
        .join(known, ["auctionid", "block"])
        .withColumn("last", F.least("last", "top"))
        .where(F.col("first") <= F.col("last"))
    )
    named = ranges.select(
        "auctionid",
        "block",
        F.explode(F.sequence("first", "last")).alias("bid"),
        F.col("username").alias("p_username"),
        "max_bid",
    )
    rows = placed.select("auctionid", "block", "bid")
    return named.join(rows, ["auctionid", "block", "bid"]).select("auctionid", "bid", "p_username", "max_bid")
