"""The live message feed: unwrap, classify, flatten.

The same projections serve a batch of stored messages and a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavel.operators.blocks import WIDTH, block_of
from gavel.schemas import FEED_BODY

# A countdown strictly between these marks an auction as live.
LIVE_ABOVE, LIVE_BELOW = 12, 30

MESSAGE_SCHEMA = T.StructType([T.StructField("seq", T.LongType()), T.StructField("message", T.StringType())])


def unwrap(message: Column) -> Column:
    """The JSON between the first "(" and the last ")"."""
    return F.regexp_extract(message, r"(?s)^[^(]*\((.*)\)", 1)


def classify(messages: DataFrame) -> DataFrame:
    """Add auction_id, kind (complete, bids, live or NULL), sl and bh.

    Only the first auction of a message counts. A body with bids is complete
    when it carries the sold mark; without bids a short countdown means live.
    """
    raw = F.from_json(F.get_json_object(unwrap(F.col("message")), "$.a"), T.MapType(T.StringType(), T.StringType()))
    # A lambda's variable is computed once for all its uses, and a filter on what is generated stays behind the
    # generator. As plain columns each use, and each filter pushed down, would read the JSON again.
    read = F.transform(F.transform(F.array(F.get(F.map_entries(raw), F.lit(0))), _opened), _classified)
    return messages.select("*", F.explode(read).alias("_m")).select(*messages.columns, "_m.*")


def _opened(first: Column) -> Column:
    """An auction's id, the body read, and the body's keys; these are NULL where it isn't an object."""
    text = first["value"]
    keys = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
    return F.struct(
        first["key"].alias("auction_id"), text.startswith("{").alias("is_object"),
        F.from_json(text, FEED_BODY).alias("b"), F.when(text.startswith("{"), keys).alias("keys"),
    )


def _classified(m: Column) -> Column:
    sl = m["b"]["sl"]
    kind = (
        F.when(~m["is_object"], None)
        .when(F.array_contains(m["keys"], "bh") & F.array_contains(m["keys"], "s"), "complete")
        .when(F.array_contains(m["keys"], "bh"), "bids")
        .when((sl > LIVE_ABOVE) & (sl < LIVE_BELOW), "live")
    )
    return F.struct(m["auction_id"].alias("auction_id"), kind.alias("kind"), sl.alias("sl"), m["b"]["bh"].alias("bh"))


def parse_feed(messages: DataFrame) -> DataFrame:
    """Messages that mean something, with kind, countdown and bid history."""
    return classify(messages).where(F.col("kind").isNotNull()).drop("message")


def odd_messages(messages: DataFrame) -> DataFrame:
    """Messages that say nothing, or carry bids without a countdown or a history: for a side table."""
    odd = F.col("kind").isNull() | ((F.col("kind") == "bids") & (F.col("sl").isNull() | F.col("bh").isNull()))
    return classify(messages).where(odd).select("seq", "message", "auction_id", "kind")


def feed_bids(parsed: DataFrame, newest_only: bool = False) -> DataFrame:
    """Bids carried by the messages, one row each, newest first by `pos`."""
    rows = parsed.where(F.col("kind") == "bids")
    bh = F.slice("bh", 1, 1) if newest_only else F.col("bh")
    return rows.select("seq", "auction_id", "sl", F.posexplode(bh).alias("pos", "e")).select(
        "seq",
        "auction_id",
        "sl",
        "pos",
        F.col("e.id").alias("bid"),
        F.col("e.u").alias("username"),
        (F.col("e.t") == 2).alias("is_bidomatic"),
    )


def read_feed(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """A stream of message files."""
    return spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", max_files).json(path)


# Sequence numbers of one auction: its 32-bit bid numbers, then the sold mark.
SEQUENCE_ROOM = 1 << 32


def render_feed(bids: DataFrame, window: int = 3, width: int = WIDTH) -> DataFrame:
    """One message per bid holding it and up to `window`-1 bids before it."""
    event = F.struct(
        F.col("bid").alias("id"),
        F.col("username").alias("u"),
        F.when(F.col("is_bidomatic"), 2).otherwise(1).alias("t"),
    )
    # Each bid is one row of its block, and of the next one if messages there go back to it.
    block = F.explode(F.sequence(block_of(F.col("bid"), width), block_of(F.col("bid") + window - 1, width))).alias("block")
    in_block = Window.partitionBy("auctionid", "block").orderBy("bid")
    upto = in_block.rangeBetween(1 - window, 0)
    messages = (
        bids.select("auctionid", "bid", event.alias("e"), block)
        .select(
            "auctionid", F.col("bid").alias("newest"), "block", F.lead("bid").over(in_block).alias("following"),
            F.reverse(F.array_sort(F.collect_list("e").over(upto))).alias("bh"),
        )
        # A bid number that is there twice has one message, which holds both.
        .where((F.col("block") == block_of(F.col("newest"), width)) & ~F.col("following").eqNullSafe(F.col("newest")))
    )
    body = F.struct(F.lit(10).alias("sl"), F.col("bh"))
    key = F.col("auctionid").cast("string")
    return messages.select(
        (F.col("auctionid") * SEQUENCE_ROOM + F.col("newest")).alias("seq"),
        F.concat(F.lit("cb("), F.to_json(F.create_map(F.lit("a"), F.create_map(key, body))), F.lit(")")).alias("message"),
    )
