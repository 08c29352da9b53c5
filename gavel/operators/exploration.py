"""Descriptive aggregates over bids and feature rows.

All are single group-bys with map-side partial aggregation; histograms and
rates are counts over a computed bucket, never a pass per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.functions.scalar import BIDS_PER_DOLLAR, ratio
from gavel.session import written

PRODUCT = ["cardtype", "cardvalue", "bidvalue"]


def rounded(col: Column, places: int = 6) -> Column:
    return F.round(col.cast("double"), places)


def rate(flag: str) -> Column:
    return rounded(F.avg(F.col(flag).cast("int")))


def bids_per_user(bids: DataFrame) -> DataFrame:
    return bids.groupBy("username").agg(F.count("*").alias("my_count")).orderBy(F.desc("my_count"), "username")


def giveup_profile(full: DataFrame) -> DataFrame:
    return (
        full.where("giveup")
        .groupBy("username")
        .agg(
            F.count("*").alias("giveups"),
            rounded(F.avg("perc_to_bin")).alias("avg_perc_to_bin"),
            rounded(F.avg("bids_so_far")).alias("g_avg_bid"),
            rounded(F.avg("bom_bids_so_far")).alias("g_bom_bid_avg"),
            rounded(F.avg("bom_streak")).alias("g_bom_streak_avg"),
        )
    )


def entry_profile(full: DataFrame, more_than: int = 10) -> DataFrame:
    return (
        full.where(F.col("debut") == 1)
        .groupBy("username")
        .agg(
            F.count("*").alias("auctions"),
            rounded(F.avg("bid")).alias("avg_debut"),
            rounded(F.avg("cashvalue")).alias("avg_cashvalue"),
        )
        .where(F.col("auctions") > more_than)
    )


def win_profile(full: DataFrame) -> DataFrame:
    """Win rate and average profit per user; the bid counts in whole dollars."""
    profit = F.col("cashvalue") - F.col("fee") - F.expr("bid div 100") - F.lit(0.4)
    return full.groupBy("username").agg(
        rate("is_winner").alias("win_perc"), rounded(F.avg(profit)).alias("profit_avg")
    )


def user_profile(full: DataFrame) -> DataFrame:
    """Entry, give-up and win aggregates side by side; entry users only."""
    return (
        entry_profile(full)
        .na.fill(0)
        .join(giveup_profile(full), "username", "left")
        .join(win_profile(full), "username", "left")
    )


def giveup_against_overall(rows: DataFrame, key: Column, name: str) -> DataFrame:
    """Give-up rate per key next to the rate over all the rows."""
    overall = rows.select(F.avg(F.col("giveup").cast("int"))).scalar()
    return (
        rows.groupBy(key.alias(name))
        .agg(rate("giveup").alias("giveup_frac"))
        .select(name, rounded(overall).alias("avg_giveup"), "giveup_frac")
    )


def giveup_against_group(rows: DataFrame, group: str, key: Column, name: str) -> DataFrame:
    """Give-up rate per group and key next to the group's own rate; the rows are counted once."""
    cells = rows.groupBy(group, key.alias(name)).agg(
        F.count("*").alias("n"), F.sum(F.col("giveup").cast("int")).alias("giveups")
    )
    cells = written(cells, "cells")
    overall = cells.groupBy(group).agg(rounded(F.sum("giveups") / F.sum("n")).alias("avg_giveup"))
    return cells.join(overall, group).select(group, name, "avg_giveup", rounded(F.col("giveups") / F.col("n")).alias("giveup_frac"))


def winning_bids_by_product(rows: DataFrame) -> DataFrame:
    """How many bids winners had placed, for products on which somebody gave up."""
    given_up = rows.where("giveup").select(*PRODUCT).distinct()
    return histogram(rows.where("is_winner"), F.col("bids_so_far"), 2.0, PRODUCT).join(given_up, PRODUCT, "left_semi")


def group_means(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    types = dict(rows.dtypes)
    cols = [F.col(c).cast("int") if types[c] == "boolean" else F.col(c) for c in values]
    return rows.groupBy(*keys).agg(*[rounded(F.avg(c)).alias(f"avg_{n}") for n, c in zip(values, cols)])


def near_price(rows: DataFrame, low: float = 0.95, high: float = 1.1) -> DataFrame:
    """Win rate where the nearest opponent has almost spent the price in bids."""
    share = ratio(F.col("bids_so_far0"), F.col("cashvalue") * F.lit(BIDS_PER_DOLLAR))
    return group_means(
        rows.withColumn("percent_near_bin", share).where(
            (F.col("percent_near_bin") > low) & (F.col("percent_near_bin") < high)
        ),
        ["percent_near_bin"],
        ["is_winner"],
    )


def product_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*PRODUCT).agg(
        F.count("*").alias("n"),
        F.sum(F.col("is_winner").cast("int")).alias("winners"),
        rounded(F.avg("bid")).alias("avg_bid"),
    )


def streak_win_rate(rows: DataFrame, by: list[str], below: int = 300) -> DataFrame:
    """Win rate by the nearest bidomatic opponent's streak."""
    return (
        rows.where(F.col("is_bidomatic0") & (F.col("bom_streak0") < below))
        .groupBy(*by, "bom_streak0")
        .agg(rate("is_winner").alias("win_rate"), F.count("*").alias("n"))
    )


def win_rate_by_opponent_bids(rows: DataFrame, cashvalues: list[int]) -> DataFrame:
    """For all the given cash values at once, with their break-even bid count."""
    return (
        rows.where(F.col("cashvalue").isin(cashvalues))
        .groupBy("cashvalue", "bids_so_far0")
        .agg(rate("is_winner").alias("win_rate"))
        .withColumn("break_even", F.col("cashvalue") * F.lit(BIDS_PER_DOLLAR))
    )


def bucket_means(rows: DataFrame, top: int = 11) -> DataFrame:
    """Give-up rate by share of the price spent, in tenths; the lowest buckets."""
    bucket = F.floor(F.floor(F.col("perc_to_bin") * 300) / F.lit(30.0)).cast("long")
    return (
        rows.where(F.col("perc_to_bin").isNotNull())
        .groupBy(bucket.alias("bucket"))
        .agg(rounded(F.avg("perc_to_bin")).alias("perc_to_bin"), rate("giveup").alias("giveup"))
        .orderBy("bucket")
        .limit(top)
    )


def histogram(rows: DataFrame, value: Column, width: float, by: list[str] | None = None) -> DataFrame:
    """Equi-width counts; bin k holds values from k to k+1 widths, and there are as many bins as the values need."""
    bin_ = F.floor(value / F.lit(width)).cast("long")
    return rows.where(value.isNotNull()).groupBy(*(by or []), bin_.alias("bin")).agg(F.count("*").alias("n"))


def density(counts: DataFrame, by: list[str], width: float) -> DataFrame:
    """Histogram counts as densities within each series; a handful of rows."""
    totals = counts.groupBy(*by).agg(F.sum("n").alias("total"))
    return counts.join(totals, by).select(
        *by, "bin", "n", rounded(F.col("n") / (F.col("total") * F.lit(width))).alias("density")
    )


def value_counts(rows: DataFrame, value: str) -> DataFrame:
    return rows.groupBy(value).agg(F.count("*").alias("n"))


def overall_counts(rows: DataFrame) -> DataFrame:
    won = F.col("is_winner").cast("int")
    return rows.agg(
        F.count("*").alias("n"),
        F.sum(won).alias("winners"),
        rounded(F.avg(won)).alias("win_rate"),
        rounded(F.avg(F.col("limited_allowed").cast("int"))).alias("limited_rate"),
        F.sum(F.when(F.col("distance1").isNull(), won)).alias("winners_one_opponent"),
    )
