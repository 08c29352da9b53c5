"""The derived tables a query starts from, built on first use."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.functions import scalar
from gavel.operators import history as h
from gavel.operators.bid_features import bid_transform, with_auction
from gavel.operators.opponents import auction_full, auction_plain
from gavel.session import work_folder, written
from gavel.sources import derived

# End of the first ten days of the test data, used as a mid-way cutoff.
MIDWAY = "2024-01-10"


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def folder(self, name: str) -> str:
        return work_folder(self.spark, name)

    @cached_property
    def bids(self) -> DataFrame:
        return derived.bids(self.spark, self.sf_dir)

    @cached_property
    def auctions(self) -> DataFrame:
        return derived.auctions(self.spark, self.sf_dir)

    @cached_property
    def day_auctions(self) -> DataFrame:
        return derived.auctions(self.spark, self.sf_dir, day_times=True)

    @cached_property
    def joined(self) -> DataFrame:
        return with_auction(self.bids, self.auctions)

    @cached_property
    def transform(self) -> DataFrame:
        return bid_transform(self.bids, self.auctions)

    @cached_property
    def history(self) -> DataFrame:
        return h.user_history(written(h.rollup(self.bids, self.auctions), "rollup"))

    @cached_property
    def plain(self) -> DataFrame:
        """Feature rows with opponents and without user history."""
        return auction_plain(self.bids, self.auctions)

    @cached_property
    def full(self) -> DataFrame:
        return auction_full(self.bids, self.auctions)

    @cached_property
    def scored(self) -> DataFrame:
        """Bids with their outcome and the pseudo-probability.

        The outcome only needs the winning price, which is one aggregate.
        """
        price = self.bids.groupBy("auctionid").agg(F.max("bid").alias("eventual_win_price"))
        rows = self.joined.join(price, "auctionid").select(
            "auctionid", "bid", "username",
            (F.col("bid") == F.col("eventual_win_price")).alias("is_winner"),
            "cashvalue", scalar.fee(F.col("cardvalue")).alias("fee"), "is_bidomatic", "auctiontime",
            "cardtype", "cardvalue", "bidvalue", "limited_allowed",
        )
        return derived.with_prob(rows)
