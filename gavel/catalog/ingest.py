"""Reading, loading and incremental runs; each writes to a new working folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.catalog.joins import snapshot
from gavel.catalog.tables import MIDWAY, Tables
from gavel.operators.bid_features import bid_transform
from gavel.plans.batch import read_batches, run_incremental, _batches
from gavel.session import written
from gavel.sources import pages, tables

CUTOFFS = [MIDWAY, MIDWAY, "2024-01-20", "2024-02-01"]


def csv_round_trip(t: Tables):
    path = t.folder("auctions_csv")
    tables.export_csv(t.auctions, path)
    return tables.import_csv(t.spark, path, t.auctions.schema)


def documents_not_in(t: Tables):
    """Auction documents stored as JSON, less those already loaded."""
    path = t.folder("auction_documents")
    t.auctions.write.json(path)
    loaded = t.auctions.where(F.col("auctiontime") < F.lit(MIDWAY).cast("timestamp_ntz"))
    docs = tables.scan_documents(t.spark, path, t.auctions.schema, loaded, "qauctionid")
    return docs.select("qauctionid", "cardtype", "cashvalue", "lock_price")


def store_pages(t: Tables):
    """Pages fetched twice; those stored before or not sold stay out."""
    fetched = pages.render_pages(t.auctions).withColumn(
        "auction_html",
        F.when(F.col("auction_html").contains("NOT LIMITED"), F.regexp_replace("auction_html", "sold", "open")).otherwise(
            F.col("auction_html")
        ),
    )
    stored = t.auctions.where(F.col("auctiontime") < F.lit(MIDWAY).cast("timestamp_ntz")).select(
        F.col("qauctionid").cast("string").alias("auction_id")
    )
    return pages.store_new_pages(fetched.unionByName(fetched), stored).select("auction_id", "auction_group")


def append_twice(t: Tables):
    """Two batches appended to one table and read back."""
    path = t.folder("bid_transform")
    tables.append(bid_transform(t.bids, t.auctions, MIDWAY), path)
    done = t.spark.read.parquet(path)
    tables.append(bid_transform(t.bids, t.auctions, None, done), path)
    return t.spark.read.parquet(path)


def incremental(t: Tables):
    """The feature table built up over several cutoffs; the auctions are derived from their bids once."""
    path = t.folder("incremental")
    run_incremental(t.spark, t.bids, written(t.auctions, "auctions"), path, CUTOFFS)
    return read_batches(t.spark, f"{path}/auction_full", _batches(t.spark, f"{path}/auction_full"))


def snapshot_saved(t: Tables):
    path = t.folder("snapshot")
    snapshot(t).write.parquet(path)
    return t.spark.read.parquet(path).select("username", "prev_auction_count0")


QUERIES = {
    "s01_scan": lambda t: tables.scan(
        t.spark, f"{t.sf_dir}/part.parquet", F.col("p_size") > 25, ["p_partkey", "p_brand", "p_size"]
    ),
    "s02_csv_round_trip": csv_round_trip,
    "s03_documents": documents_not_in,
    "s04_store_pages": store_pages,
    "s05_append": append_twice,
    "s06_incremental": incremental,
    "s07_modulo_batch": lambda t: tables.modulo_batch(t.bids, 3, 10),
    "s08_snapshot_saved": snapshot_saved,
    "s09_purge": lambda t: pages.purge(t.bids, t.auctions, MIDWAY)[0],
}
