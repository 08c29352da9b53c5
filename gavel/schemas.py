"""Fixed schemas and column contracts."""

from __future__ import annotations

from pyspark.sql import types as T

BIDS = T.StructType(
    [
        T.StructField("auctionid", T.LongType(), False),
        T.StructField("bid", T.IntegerType(), False),
        T.StructField("username", T.StringType(), False),
        T.StructField("is_bidomatic", T.BooleanType(), False),
    ]
)

AUCTIONS = T.StructType(
    [
        T.StructField("qauctionid", T.LongType(), False),
        T.StructField("cardvalue", T.IntegerType(), False),
        T.StructField("bidvalue", T.IntegerType(), False),
        T.StructField("tracking", T.DoubleType(), False),
        T.StructField("auctiontime", T.TimestampNTZType(), False),
        T.StructField("runtime", T.IntegerType(), False),
        T.StructField("limited_allowed", T.BooleanType(), False),
        T.StructField("cashvalue", T.IntegerType(), False),
        T.StructField("cardtype", T.StringType(), False),
        T.StructField("lock_price", T.IntegerType(), False),
    ]
)

PAGES_RAW = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("auction_id", "auction_group", "auction_html", "table_html", "history_html")
    ]
)

BID_EVENT = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("u", T.StringType()),
        T.StructField("t", T.IntegerType()),
    ]
)

# One live message body: seconds left, sold marker, bid history newest first.
FEED_BODY = T.StructType(
    [
        T.StructField("sl", T.IntegerType()),
        T.StructField("s", T.StringType()),
        T.StructField("bh", T.ArrayType(BID_EVENT)),
    ]
)

# The column contract of the feature table.
BASE_COLUMNS = [
    "auctionid", "is_winner", "cardtype", "cashvalue", "cardvalue", "fee", "bidvalue",
    "limited_allowed", "is_locked", "auctiontime", "bid", "is_bidomatic", "bids_so_far",
    "username", "prevusers", "giveup", "eventual_bids", "eventual_win_price", "debut",
    "bom_streak", "bom_bids_so_far", "perc_to_bin",
]
OPPONENT_COLUMNS = [
    "username", "distance", "is_bidomatic", "bids_so_far", "bom_bids_so_far", "bom_streak",
    "perc_to_bin", "prev_is_new_user", "prev_auction_count", "prev_overbid",
    "prev_giveup_one", "prev_give_before_six", "prev_wins", "prev_bids", "prev_bom_bids",
]
HISTORY_COLUMNS = [
    "prev_auction_count", "prev_overbid", "prev_giveup_one", "prev_give_before_six",
    "prev_wins", "prev_bids", "prev_bom_bids",
]
OPPONENTS = 4


def opponent_columns(i: int) -> list[str]:
    return [f"{name}{i}" for name in OPPONENT_COLUMNS]


FEATURE_COLUMNS = BASE_COLUMNS + [c for i in range(OPPONENTS) for c in opponent_columns(i)]

# Model inputs. Opponent 0 is always at distance 1, so it has no
# distance feature; its username is never a feature.
CATEGORICAL_FEATURES = ["cardtype", "limited_allowed", "is_locked", "is_bidomatic"] + [
    f"is_bidomatic{i}" for i in range(OPPONENTS)
]
NUMERIC_FEATURES = (
    ["bid", "cashvalue", "bidvalue", "prevusers"]
    + [
        c
        for i in range(OPPONENTS)
        for c in opponent_columns(i)
        if not c.startswith(("username", "is_bidomatic")) and c != "distance0"
    ]
    + ["is_weekend", "time_of_day"]
)

# The live state of an auction, as the stream sends it.
OPPONENT_STATE = T.StructType(
    [
        T.StructField("username", T.StringType()),
        T.StructField("bid", T.IntegerType()),
        T.StructField("is_bidomatic", T.BooleanType()),
        T.StructField("bids_so_far", T.LongType()),
        T.StructField("bom_bids_so_far", T.LongType()),
        T.StructField("bom_streak", T.LongType()),
    ]
)
LIVE_STATE = T.StructType(
    [
        T.StructField("auction_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("n_bids", T.LongType()),
        T.StructField("last_bid", T.IntegerType()),
        T.StructField("last_user", T.StringType()),
        T.StructField("sl", T.IntegerType()),
        T.StructField("is_live", T.BooleanType()),
        T.StructField("complete", T.BooleanType()),
        T.StructField("prevusers", T.LongType()),
        T.StructField("opponents", T.ArrayType(OPPONENT_STATE)),
    ]
)
