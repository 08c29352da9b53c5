"""Live auctions: state per auction, features for the next bid, current board.

Batch functions (`kept_bids`, `live_states_batch`) describe a finished feed
with windows; `live_states` keeps the same facts as streaming state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.functions import scalar
from gavel.operators.bid_features import bid_transform
from gavel.operators.blocks import WIDTH, block_of, running
from gavel.operators.evaluation import live_expected
from gavel.operators.history import lookup
from gavel.operators.opponents import recent_users
from gavel.schemas import FEATURE_COLUMNS, HISTORY_COLUMNS, OPPONENT_STATE, OPPONENTS
from gavel.session import written
from gavel.streaming.tracker import FIRST_SECONDS_LEFT, tracked_states

# The account that bids, by default; fixed value: how far the site clock is behind.
MY_USERNAME = "me"
CLOCK_OFFSET_HOURS = -4


def live_states(parsed: DataFrame, me: str = MY_USERNAME, every: bool = False, idle_ms: int | None = None) -> DataFrame:
    """Streaming state per auction; a row whenever its bids or live flag change (see `tracked_states`)."""
    return tracked_states(parsed, me, every, idle_ms).where(F.col("my_bid").isNull()).drop("my_bid")


def tracking_ok() -> Column:
    """No gap: the last bid number is the count of bids."""
    return F.col("last_bid").isNull() | (F.col("last_bid") == F.col("n_bids"))


def kept_bids(feed_bids: DataFrame, width: int = WIDTH) -> DataFrame:
    """Bids a finished, ordered feed leaves: the unbroken run from the oldest
    bid of the first message. (A feed with late messages needs the state.)

    The start, the carry-ins and the run all need the events, one row a bid:
    these are written once, so that the messages aren't read again for each.
    """
    events = feed_bids.groupBy("auction_id", "bid").agg(
        F.min(F.struct("seq", (-F.col("pos")).alias("place"), "username", "is_bidomatic")).alias("e")
    )
    events = written(events.select("auction_id", "bid", "e.seq", "e.username", "e.is_bidomatic"), "events")
    start = events.groupBy("auction_id").agg(F.min(F.struct("seq", "bid"))["bid"].alias("start"))
    seen = events.join(start, "auction_id").where(F.col("bid") >= F.col("start"))
    seen = seen.withColumn("bid_block", block_of(F.col("bid"), width))
    counted = running(seen, ["auction_id"], ["bid_block"], ["bid"], {"upto": F.lit(1)})
    return counted.where(F.col("upto") == F.col("bid") - F.col("start") + 1).select(
        "auction_id", "bid", "username", "is_bidomatic"
    )


def gap_flags(kept: DataFrame) -> DataFrame:
    return kept.groupBy("auction_id").agg(
        F.max("bid").alias("last_bid"),
        F.count("*").alias("n_bids"),
        (F.max("bid") == F.count("*")).alias("tracking_ok"),
    )


def live_states_batch(
    bids: DataFrame, auctions: DataFrame, me: str = MY_USERNAME, width: int = WIDTH
) -> DataFrame:
    """The live state after every bid, from stored bids: same columns that
    `live_states` gives, computed with the batch windows."""
    rows = bid_transform(bids, auctions, strict_islands=True, width=width)
    entry = [f.name for f in OPPONENT_STATE.fields]
    chained = recent_users(rows, entry, OPPONENTS, width)
    mine = bids.where(F.col("username") == me).groupBy("auctionid").agg(F.min("bid").alias("my_first"))
    own = F.struct(*entry)
    seen = F.array(own, *[F.col(f"_d{i + 1}") for i in range(OPPONENTS)])
    others = F.slice(F.filter(seen, lambda e: e.isNotNull() & (e["username"] != me)), 1, OPPONENTS)
    my_seat = F.coalesce(F.col("my_first") <= F.col("bid"), F.lit(False)).cast("int")
    return chained.join(mine, "auctionid", "left").select(
        F.col("auctionid").cast("string").alias("auction_id"),
        F.col("bid").cast("long").alias("n_bids"),
        F.col("bid").alias("last_bid"),
        F.col("username").alias("last_user"),
        (F.col("prevusers") + 1 - my_seat).alias("prevusers"),
        others.alias("opponents"),
    )


def auction_end(now: Column, seconds_left: Column) -> Column:
    """When the auction would end, on the site's clock."""
    return now + F.make_interval(hours=F.lit(CLOCK_OFFSET_HOURS)) + F.make_interval(secs=seconds_left)


def live_features(
    states: DataFrame,
    auctions: DataFrame,
    snapshot: DataFrame | None = None,
    now: Column | None = None,
    me: str = MY_USERNAME,
) -> DataFrame:
    """The feature row for the next bid of each state, padded to four opponents.

    `auctions` and `snapshot` are static, `states` may be a stream; a batch of
    states is joined with the snapshot once for all its opponents. The next bid
    is one more than the bids kept, even after a gap.
    """
    info = auctions.select(
        F.col("qauctionid").cast("string").alias("auction_id"),
        "cashvalue", "cardvalue", "cardtype", "bidvalue", "limited_allowed",
    )
    if "sl" not in states.columns:
        states = states.withColumn("sl", F.lit(FIRST_SECONDS_LEFT))
    out = states.join(info, "auction_id").withColumn("bid", F.col("n_bids") + 1)
    attributes = {}
    for i in range(OPPONENTS):
        e = F.get("opponents", F.lit(i))
        attributes[f"username{i}"] = e["username"]
        attributes[f"distance{i}"] = F.col("bid") - e["bid"]
        for c in ("is_bidomatic", "bids_so_far", "bom_bids_so_far", "bom_streak"):
            attributes[f"{c}{i}"] = e[c]
        attributes[f"perc_to_bin{i}"] = scalar.perc_to_bin(e["bids_so_far"], F.col("cashvalue"))
    out = out.withColumns(attributes)
    if snapshot is not None:
        if states.isStreaming:
            for i in range(OPPONENTS):
                out = _with_history(out, snapshot, i)
        else:
            out = _with_histories(out, snapshot)
    unknown = {
        "is_winner": "boolean", "bids_so_far": "long", "giveup": "boolean", "eventual_bids": "long",
        "eventual_win_price": "int", "debut": "int", "bom_streak": "long", "bom_bids_so_far": "long",
        "perc_to_bin": "double",
    }
    out = out.withColumns(
        {
            **{c: F.lit(None).cast(t) for c, t in unknown.items()},
            "auctionid": F.col("auction_id").cast("long"),
            "fee": scalar.fee(F.col("cardvalue")),
            "is_locked": F.lit(False),
            "is_bidomatic": F.lit(True),
            "username": F.lit(me),
            "auctiontime": auction_end(now, F.col("sl")) if now is not None else F.lit(None).cast("timestamp_ntz"),
        }
    )
    have = [c for c in FEATURE_COLUMNS if c in out.columns]
    more = [c for c in ("seq", "sl", "is_live", "complete", "n_bids", "last_bid", "last_user") if c in out.columns]
    return out.select(*have, *more)


def _with_history(df: DataFrame, snapshot: DataFrame, i: int) -> DataFrame:
    """Snapshot values of opponent i; all NULL where there is no such opponent."""
    named = snapshot.select(F.col("username"), *[f"{c}0" for c in HISTORY_COLUMNS])
    slim = df.withColumnRenamed("username", "_u") if "username" in df.columns else df
    known = lookup(slim.withColumn("username", F.col(f"username{i}")), named)
    there = F.col(f"username{i}").isNotNull()
    return known.select(
        *df.columns,
        *[F.when(there, F.col(c)).alias(f"{c}{i}") for c in ["prev_is_new_user", *HISTORY_COLUMNS]],
    )


def _with_histories(df: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The same for all opponents of a batch: one row per seat meets the snapshot, then seats are gathered by place."""
    names = ["prev_is_new_user", *HISTORY_COLUMNS]
    key = ["auction_id", "seq" if "seq" in df.columns else "n_bids"]
    seats = df.select(*key, F.posexplode("opponents").alias("place", "e")).select(*key, "place", "e.username")
    known = lookup(seats, snapshot.select("username", *[f"{c}0" for c in HISTORY_COLUMNS]))
    gathered = known.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("place", *names))).alias("_seats"))
    cells = [F.get("_seats", F.lit(i))[c].alias(f"{c}{i}") for i in range(OPPONENTS) for c in names]
    return df.join(gathered, key, "left").select(*df.columns, *cells)


def scenarios(features: DataFrame) -> DataFrame:
    """Each row twice: the next bid by the bidomatic, and by hand."""
    return features.withColumn("is_bidomatic", F.explode(F.array(F.lit(True), F.lit(False))))


def live_ev(features: DataFrame, model) -> DataFrame:
    """Both scenarios scored and valued; works on a stream, as no rows meet.

    `model` is a fitted WinModel.
    """
    out = features
    for flag, name in ((True, "bom_proba"), (False, "manual_proba")):
        scored = model.score(out.withColumn("is_bidomatic", F.lit(flag)))
        out = scored.withColumnRenamed("prob", name).drop("predicted")
    return live_expected(out)


def latest_per_auction(states: DataFrame, key: str = "auction_id") -> DataFrame:
    """The last state of each auction, combined before the shuffle."""
    rest = [c for c in states.columns if c not in (key, "seq")]
    return states.groupBy(key).agg(F.max_by(F.struct("seq", *rest), "seq").alias("s")).select(key, "s.*")


def merge_board(board: DataFrame, batch: DataFrame) -> DataFrame:
    """The board after a batch: last state wins, completed auctions leave."""
    new = latest_per_auction(batch)
    kept = board.join(new.select("auction_id"), "auction_id", "left_anti")
    return kept.unionByName(new.select(*board.columns)).where(~F.coalesce("complete", F.lit(False)))


# Board versions take turns in so many folders: the one before is whole while the next is written, and old ones go.
SLOTS = 3


def board_path(path: str, batch_id: int) -> str:
    return f"{path}/slot={(batch_id + 1) % SLOTS}"


def board_sink(path: str):
    """A foreachBatch writer that keeps the board as table versions in turning slots.

    The next version is written from the one before and the batch, then readers
    move on, so a lost executor or a replayed batch leaves a whole board behind.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0:
            board = batch.limit(0)
        else:
            board = spark.read.schema(batch.schema).parquet(board_path(path, batch_id - 1))
        merge_board(board, batch).write.mode("overwrite").parquet(board_path(path, batch_id))

    return write


def upcoming_sink(path: str):
    """A foreachBatch writer of lists of upcoming auctions whose rows name their list and its size.

    Rows are kept by trigger, written over if it is replayed. A list counts once
    all its rows are there, in however many files and triggers they came; then
    a line names it, after its rows are stored. The list with the greatest id
    named so far is the current one (`current_list`).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/rows/trigger={batch_id}")
        rows = _listed_rows(spark, path, batch.schema)
        whole = rows.groupBy("list_id").agg(F.count("*").alias("n"), F.max("list_size").alias("of")).where(F.col("n") >= F.col("of"))
        whole.select("list_id").write.mode("overwrite").parquet(f"{path}/whole/trigger={batch_id}")

    return write


def _listed_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows so far; a file that was sent again brings its rows once."""
    return spark.read.schema(schema).parquet(f"{path}/rows").select(*schema.names).distinct()


def current_list(spark: SparkSession, path: str, schema) -> DataFrame:
    """The latest whole list."""
    last = spark.read.schema("list_id long").parquet(f"{path}/whole").agg(F.max("list_id").alias("list_id"))
    rows = _listed_rows(spark, path, schema)
    return rows.join(last, "list_id", "left_semi").drop("list_id", "list_size")


def listed(rows: DataFrame, list_id: int) -> DataFrame:
    """Rows of one list with its id and size, as a source sends them."""
    size = rows.agg(F.count("*").alias("list_size"))
    return rows.select(F.lit(list_id).cast("long").alias("list_id"), "*").join(size)


def own_last_bids(states: DataFrame, me: str = MY_USERNAME) -> DataFrame:
    """For each bid of mine, the state just before it (one bid fewer)."""
    mine = states.where(F.col("last_user") == me).select("auction_id", F.col("last_bid").alias("my_bid"))
    prior = states.withColumn("my_bid", F.col("last_bid") + 1)
    return prior.join(mine, ["auction_id", "my_bid"])


def upcoming_candidates(upcoming: DataFrame, launched: DataFrame, within: int | None = None) -> DataFrame:
    """Auctions worth watching that are not launched; `within` seconds of the end."""
    worth = F.col("cardtype").isin("None", "Buster") | (F.col("cardvalue") >= 25)
    out = upcoming.where(worth).join(launched.select("auctionid").distinct(), "auctionid", "left_anti")
    return out if within is None else out.where(F.col("seconds_left") < within)


def _shown(name: str) -> Column:
    """A number to print: halves go up, whatever the last binary digit says."""
    return F.round(F.col(name), 6) + F.lit(1e-9)


def board_labels(tracking: DataFrame) -> DataFrame:
    """Display texts and flags of the board."""
    pack = F.concat(F.lit("Bid Pack "), F.col("bidvalue").cast("string"))
    card = F.concat(F.col("cardtype"), F.lit(" $"), F.col("cardvalue").cast("string"))
    seconds = F.col("sl")
    good = (F.col("manual_ev") >= 0) | (F.col("bom_ev") >= 0)
    return tracking.select(
        "auction_id",
        F.concat(F.col("auction_id"), F.lit(": "), F.when(F.col("cardtype") == "None", pack).otherwise(card)).alias("title"),
        F.concat(
            F.expr("sl div 60").cast("string"), F.lit("m "), (seconds % 60).cast("string"), F.lit("s")
        ).alias("time_left"),
        F.format_string("%.2f", _shown("potential_profit")).alias("profit_text"),
        F.format_string("%.4f", "bom_proba").alias("proba_text"),
        F.format_string("%.2f", _shown("bom_ev")).alias("ev_text"),
        F.when(F.col("bom_ev") >= 0, "green").otherwise("red").alias("console_color"),
        F.when(F.col("bom_ev") <= 0, "red").otherwise("green").alias("page_color"),
        (F.col("is_live") & good).alias("alert"),
        F.when(F.col("tracking_ok"), "").otherwise("NOT FULLY TRACKING!").alias("tracking_text"),
    )


def upcoming_labels(upcoming: DataFrame) -> DataFrame:
    """One display line per upcoming auction."""
    pack = F.concat(F.lit("Bid Pack "), F.col("bidvalue").cast("string"))
    card = F.concat(F.col("cardtype"), F.lit(" $"), F.col("cardvalue").cast("string"))
    return upcoming.select(
        "auctionid",
        F.concat(
            F.expr("seconds_left div 60").cast("string"), F.lit("m "), (F.col("seconds_left") % 60).cast("string"),
            F.lit("s :"), F.when(F.col("cardtype") == "None", pack).otherwise(card),
            F.lit(" ("), F.col("auctionid"), F.lit(")"),
        ).alias("line"),
    )


def first_on_board(tracking: DataFrame, n: int = 10) -> DataFrame:
    """The first n auctions that have an expected value."""
    return tracking.where(F.col("bom_ev").isNotNull()).orderBy("auction_id").limit(n)
