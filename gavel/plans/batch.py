"""The batch refresh: feature tables kept up to date by cutoff dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.operators import history as h
from gavel.operators.bid_features import bid_transform, has_long, pending_auctions
from gavel.operators.opponents import full_rows
from gavel.session import written


def cutoffs(first: dt.date, last: dt.date) -> list[str]:
    """Every day from first to last, both included."""
    return [str(first + dt.timedelta(days=i)) for i in range((last - first).days + 1)]


def _batches(spark: SparkSession, table_dir: str) -> list[str]:
    """Folders of the batches written to the end, by their success marks."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table_dir}/batch=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(mark.getPath().getParent()) for mark in found or [])


def read_batches(spark: SparkSession, table_dir: str, folders: list[str] | None = None) -> DataFrame | None:
    """The finished batches of a table, or None when there are none."""
    folders = _batches(spark, table_dir) if folders is None else folders
    return spark.read.parquet(*folders) if folders else None


def pending_count(auctions: DataFrame, cutoff: str, done: DataFrame | None) -> int:
    return pending_auctions(auctions, cutoff, done).count()


def run_batch(spark: SparkSession, bids: DataFrame, auctions: DataFrame, out_dir: str, cutoff: str) -> int:
    """Append the pending auctions' rows to bid_transform and auction_full.

    Returns how many auctions were pending; with none, nothing is written. The
    pending auctions and their bids, four columns, are written once to working
    tables, and every step reads those alone. A batch also appends its (auction,
    user) rollup; history and the list of finished auctions come from these
    rollups, so no batch reads the bids of earlier ones. Both feature tables are
    built from the narrow bids: passing the wide rows of one on to the other
    would shuffle them twice. Each batch has its own folder in every table: a
    batch cut short is not counted as done and is written over when run again.
    """
    transform_dir, rollup_dir, full_dir = (f"{out_dir}/{name}" for name in ("bid_transform", "rollup", "auction_full"))
    finished = [f.replace(full_dir, rollup_dir) for f in _batches(spark, full_dir)]
    done = read_batches(spark, rollup_dir, finished)
    live = written(pending_auctions(auctions, cutoff, done), "pending")
    n = live.count()
    if n == 0:
        return 0
    ids = live.select(F.col("qauctionid").alias("auctionid"))
    columns = ["auctionid", "bid", "username", "is_bidomatic"]
    new = written(bids.select(*columns).join(ids, "auctionid", "left_semi"), "pending_bids")
    long_bids = has_long(new)
    bid_transform(new, live, long_bids=long_bids).write.mode("overwrite").parquet(f"{transform_dir}/batch={cutoff}")
    own = f"{rollup_dir}/batch={cutoff}"
    h.rollup(new, live).write.mode("overwrite").parquet(own)
    hist = h.user_history(spark.read.parquet(*finished, own))
    if finished:
        hist = hist.join(ids, "auctionid", "left_semi")
    full = full_rows(new, live, hist, long_bids=long_bids)
    full.write.mode("overwrite").parquet(f"{full_dir}/batch={cutoff}")
    return n


def run_incremental(
    spark: SparkSession, bids: DataFrame, auctions: DataFrame, out_dir: str, days: list[str]
) -> dict[str, int]:
    """run_batch for each cutoff in turn; pending auctions per cutoff."""
    return {day: run_batch(spark, bids, auctions, out_dir, day) for day in days}
