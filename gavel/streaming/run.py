"""Running the live stream to the end of what has arrived."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.streaming.feed import MESSAGE_SCHEMA, parse_feed, read_feed
from gavel.streaming.live import board_path, board_sink, current_list, latest_per_auction, live_features, upcoming_sink
from gavel.streaming.tracker import OUT as TRACKED
from gavel.streaming.tracker import tracked_states


def _finish(query) -> None:
    query.awaitTermination()
    error = query.exception()
    if error is not None:
        raise error


def ingest(spark: SparkSession, feed_dir: str, out_dir: str) -> DataFrame:
    """Append the parsed messages of all arrived files to a table and read it."""
    parsed = parse_feed(read_feed(spark, feed_dir))
    _finish(
        parsed.writeStream.format("parquet")
        .option("checkpointLocation", f"{out_dir}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(f"{out_dir}/messages")
    )
    return spark.read.schema(parsed.schema).parquet(f"{out_dir}/messages")


def track(
    spark: SparkSession,
    feed_dir: str,
    out_dir: str,
    me: str,
    every: bool = False,
    max_files: int = 100,
    valued: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(all emitted states, current board) after the arrived files, in one streaming query.

    `valued` turns a trigger's states into rows of the board, such as `valued_rows`.
    A trigger's states go to its own folder, written over if it is replayed.
    """
    states = tracked_states(parse_feed(read_feed(spark, feed_dir, max_files)), me, every)
    to_board = board_sink(f"{out_dir}/board")

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{out_dir}/states/trigger={batch_id}"
        batch.write.mode("overwrite").parquet(folder)
        new = batch.sparkSession.read.schema(batch.schema).parquet(folder).where("my_bid IS NULL").drop("my_bid")
        to_board(new if valued is None else valued(latest_per_auction(new)), batch_id)

    query = (
        states.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", f"{out_dir}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    _finish(query)
    board = spark.read.parquet(board_path(f"{out_dir}/board", query.lastProgress["batchId"]))
    return emitted_states(spark, out_dir).where("my_bid IS NULL").drop("my_bid"), board


def emitted_states(spark: SparkSession, out_dir: str) -> DataFrame:
    """Every row that `track` has sent out, those before own bids included."""
    return spark.read.schema(TRACKED).parquet(f"{out_dir}/states")


def valued_rows(auctions: DataFrame, snapshot: DataFrame | None, value: Callable[[DataFrame], DataFrame], me: str) -> Callable[[DataFrame], DataFrame]:
    """States to rows of a board: features of the next bid, then `value` adds the expected values of both ways to bid.

    `auctions` and `snapshot` are read again by each trigger, as their tables are by then.
    """

    def board_rows(states: DataFrame) -> DataFrame:
        rows = value(live_features(states, auctions, snapshot, now=F.current_timestamp().cast("timestamp_ntz"), me=me))
        return states.join(rows.drop(*[c for c in rows.columns if c in states.columns and c != "auction_id"]).withColumn(
            "auction_id", F.col("auctionid").cast("string")), "auction_id")

    return board_rows


def replace_latest(spark: SparkSession, source_dir: str, schema, out_dir: str, max_files: int = 1) -> DataFrame:
    """Take arriving files of upcoming auctions (columns list_id and list_size beside the list's); the latest whole list."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(source_dir)
    query = (
        stream.writeStream.foreachBatch(upcoming_sink(out_dir))
        .option("checkpointLocation", f"{out_dir}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    _finish(query)
    return current_list(spark, out_dir, schema)


def write_feed(messages: DataFrame, path: str) -> None:
    """Messages as JSON files for a stream to pick up."""
    messages.select(*[F.col(f.name).cast(f.dataType) for f in MESSAGE_SCHEMA.fields]).write.json(path)
