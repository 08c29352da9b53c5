"""Bid-event tables derived from the supplied test tables.

`events` rows are read as bids: each run of forty event ids is two auctions of
varied lengths, and six users of the events share a bidder's name, so bidders
meet again within an auction and their number grows with the data. `part`
supplies the product columns; auctions without a part get defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = 40  # event ids of two auctions
USERS_A_NAME = 6


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, place = F.expr(f"event_id div {RUN}"), F.col("event_id") % RUN
    first = 12 + (run * 7) % 29  # bids of the run's first auction, the others are the second's
    return _table(spark, sf_dir, "events").select(
        F.when(place < first, run * 2).otherwise(run * 2 + 1).alias("auctionid"),
        F.when(place < first, place + 1).otherwise(place - first + 1).cast("int").alias("bid"),
        F.concat(F.lit("u"), F.expr(f"user_id div {USERS_A_NAME}").cast("string")).alias("username"),
        F.col("event_type").isin("click", "view").alias("is_bidomatic"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
    )


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bid_events(spark, sf_dir).select("auctionid", "bid", "username", "is_bidomatic")


def auctions(spark: SparkSession, sf_dir: str, day_times: bool = False) -> DataFrame:
    """The auctions table. `day_times` truncates end times to the day, so that
    many auctions end together."""
    last = F.max("ts")
    spans = (
        _bid_events(spark, sf_dir)
        .groupBy("auctionid")
        .agg(
            last.alias("auctiontime"),
            F.floor(F.unix_micros(last.cast("timestamp")) / 1000000).alias("t1"),
            F.floor(F.unix_micros(F.min("ts").cast("timestamp")) / 1000000).alias("t0"),
        )
    )
    size, key = F.coalesce("p_size", F.lit(1)), F.col("auctionid")
    cash = 1 + size % 4
    card = F.when(size % 3 == 0, 0).when(size % 3 == 1, 25).otherwise(75)
    when = F.date_trunc("day", F.col("auctiontime")).cast("timestamp_ntz") if day_times else F.col("auctiontime")
    return spans.join(_table(spark, sf_dir, "part"), F.col("p_partkey") == key, "left").select(
        F.col("auctionid").alias("qauctionid"),
        card.cast("int").alias("cardvalue"),
        F.round((cash - card) * F.lit(2.5), 0).cast("int").alias("bidvalue"),
        F.when(key % 50 == 0, 99.5).otherwise(100.0).alias("tracking"),
        when.alias("auctiontime"),
        (F.col("t1") - F.col("t0")).cast("int").alias("runtime"),
        (size % 2 == 0).alias("limited_allowed"),
        cash.cast("int").alias("cashvalue"),
        F.coalesce("p_brand", F.lit("None")).alias("cardtype"),
        F.when(size % 5 == 0, 10).otherwise(0).cast("int").alias("lock_price"),
    )


def with_prob(df: DataFrame) -> DataFrame:
    """A deterministic pseudo-probability per bid, for checks without a model."""
    return df.withColumn("prob", ((F.col("auctionid") * 31 + F.col("bid") * 17) % 100) / F.lit(100.0))
