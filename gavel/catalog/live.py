"""The live side: feed ingestion, state per auction, next-bid features, board."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.catalog.joins import snapshot
from gavel.catalog.modelling import fitted, modelled
from gavel.catalog.parsing import messages
from gavel.catalog.projections import board, upcoming_list
from gavel.catalog.tables import Tables
from gavel.functions import scalar
from gavel.operators.evaluation import live_expected
from gavel.operators.exploration import rounded
from gavel.schemas import HISTORY_COLUMNS, LIVE_STATE
from gavel.session import written
from gavel.streaming import feed, live, run

ME = "u1"
STATE = ["auction_id", "n_bids", "last_bid", "last_user", "prevusers"]
SEEN = ["username", "distance", "is_bidomatic", "bids_so_far", "bom_bids_so_far", "bom_streak", "perc_to_bin"]


def _message(body, auction, at):
    text = F.concat(F.lit('cb({"a":{"'), auction.cast("string"), F.lit('":'), body, F.lit("}})"))
    return [(auction * feed.SEQUENCE_ROOM + at).alias("seq"), text.alias("message")]


def whole_feed(t: Tables):
    """Bids, a countdown for some auctions and the sold mark for others."""
    ids = t.auctions.select("qauctionid", "limited_allowed", "cashvalue")
    countdown = ids.where("limited_allowed").select(*_message(F.lit('{"sl":20}'), F.col("qauctionid"), F.lit(0)))
    sold = ids.where(F.col("cashvalue") == 4).select(
        *_message(F.lit('{"sl":0,"s":"x","bh":[]}'), F.col("qauctionid"), F.lit(feed.SEQUENCE_ROOM - 1))
    )
    return messages(t).unionByName(countdown).unionByName(sold)


def tracked(t: Tables, every: bool = False):
    folder = t.folder("live")
    run.write_feed(whole_feed(t), f"{folder}/feed")
    return run.track(t.spark, f"{folder}/feed", folder, ME, every)


def ingested(t: Tables):
    folder = t.folder("ingest")
    run.write_feed(messages(t), f"{folder}/feed")
    return feed.feed_bids(run.ingest(t.spark, f"{folder}/feed", folder)).drop("sl")


def kept(t: Tables):
    return live.kept_bids(feed.feed_bids(feed.parse_feed(messages(t))))


def streamed_states(t: Tables):
    return live.latest_per_auction(tracked(t)[0]).select(*STATE, "is_live", "complete", live.tracking_ok().alias("tracking_ok"))


def streamed_opponents(t: Tables):
    """The opponents the stream state holds at the end of each auction."""
    last = live.latest_per_auction(tracked(t)[0])
    return last.select("auction_id", F.posexplode("opponents").alias("place", "e")).select(
        "auction_id", "place", "e.username", "e.bid", "e.is_bidomatic", "e.bids_so_far", "e.bom_bids_so_far", "e.bom_streak"
    )


def next_bid_features(t: Tables):
    """Opponent features as the bid after every stored bid would see them."""
    rows = live.live_features(live.live_states_batch(t.bids, t.auctions, ME), t.auctions, me=ME)
    return rows.select("auctionid", "bid", "prevusers", *[f"{c}{i}" for i in range(4) for c in SEEN])


def padded(t: Tables):
    """How many of the four opponent places are empty, per next bid."""
    rows = live.live_features(live.live_states_batch(t.bids, t.auctions, ME), t.auctions, me=ME)
    empty = sum((F.col(f"username{i}").isNull().cast("int") for i in range(4)), F.lit(0))
    return rows.select("auctionid", "bid", empty.alias("empty"))


def auction_rows(t: Tables):
    states = t.bids.groupBy(F.col("auctionid").cast("string").alias("auction_id")).agg(
        F.max("bid").cast("long").alias("n_bids"), F.max("bid").alias("last_bid")
    )
    states = states.join(
        t.auctions.select(F.col("qauctionid").cast("string").alias("auction_id"), (F.col("runtime") % 600).alias("sl"), F.col("auctiontime").alias("now")),
        "auction_id",
    ).withColumns({"opponents": F.array().cast(LIVE_STATE["opponents"].dataType), "prevusers": F.lit(0)})
    rows = live.live_features(states, t.auctions, now=F.col("now"))
    return rows.select("auctionid", "bid", "auctiontime", "fee", "is_winner", "is_locked", "username", "is_bidomatic")


def with_snapshot(t: Tables):
    """History of the opponents at the end of each auction, from the snapshot."""
    last = live.latest_per_auction(
        live.live_states_batch(t.bids, t.auctions, ME).withColumn("seq", F.col("n_bids"))
    )
    rows = live.live_features(last, t.auctions, written(snapshot(t), "snapshot"), me=ME)
    return rows.select(
        "auctionid",
        *[f"username{i}" for i in range(4)],
        *[f"prev_is_new_user{i}" for i in range(4)],
        *[rounded(F.col(f"{c}{i}")).alias(f"{c}{i}") for i in range(4) for c in HISTORY_COLUMNS],
    )


def current_board(t: Tables):
    return tracked(t)[1].select(*STATE, "is_live")


def own_bids(t: Tables):
    states = live.live_states_batch(t.bids, t.auctions, ME)
    return live.own_last_bids(states, ME).select("auction_id", "my_bid", "n_bids", "last_user", "prevusers")


def streamed_own_bids(t: Tables):
    """The same rows as the stream sends them when it reaches a bid of mine."""
    folder = t.folder("live")
    run.write_feed(whole_feed(t), f"{folder}/feed")
    run.track(t.spark, f"{folder}/feed", folder, ME)
    rows = run.emitted_states(t.spark, folder).where("my_bid IS NOT NULL")
    return rows.select("auction_id", "my_bid", "n_bids", "last_user", "prevusers")


def pseudo_values(rows):
    """Expected values from the pseudo-probability of the next bid."""
    prob = lambda bom: ((F.col("auctionid") * 31 + F.col("bid") * 17 + bom) % 100) / F.lit(100.0)
    return live_expected(rows.withColumns({"bom_proba": prob(1), "manual_proba": prob(0)}))


def valued_board(t: Tables):
    """One streaming query from messages to a board with features, history and both expected values."""
    folder = t.folder("live")
    run.write_feed(whole_feed(t), f"{folder}/feed")
    rows = run.valued_rows(written(t.auctions, "auctions"), written(snapshot(t), "snapshot"), pseudo_values, ME)
    board = run.track(t.spark, f"{folder}/feed", folder, ME, valued=rows)[1]
    return board.select(
        *STATE, "is_live", "username0", "distance0", "prev_is_new_user0", rounded(F.col("prev_auction_count0")).alias("prev_auction_count0"),
        rounded(F.col("prev_bids0")).alias("prev_bids0"), "username3", rounded(F.col("prev_bids3")).alias("prev_bids3"),
        *[rounded(F.col(c)).alias(c) for c in ("potential_profit", "bom_ev", "manual_ev")],
    )


def replaced_upcoming(t: Tables):
    """Two lists arrive in several files each, the later one first in part; the later whole list is the current one."""
    folder = t.folder("upcoming")
    everything = live.listed(upcoming_list(t), 1)
    later = live.listed(live.upcoming_candidates(upcoming_list(t), t.auctions.select(F.col("qauctionid").cast("string").alias("auctionid"))), 2)
    for rows in (everything, later):
        rows.repartition(3, "auctionid").write.mode("append").json(f"{folder}/lists")
    return run.replace_latest(t.spark, f"{folder}/lists", everything.schema, f"{folder}/out")


def live_values(t: Tables):
    """Both scenarios of the next bid, scored with the pseudo-probability."""
    states = live.latest_per_auction(
        live.live_states_batch(t.bids, t.auctions, ME).withColumn("seq", F.col("n_bids"))
    )
    rows = live.scenarios(live.live_features(states, t.auctions, me=ME))
    prob = ((F.col("auctionid") * 31 + F.col("bid") * 17 + F.col("is_bidomatic").cast("int")) % 100) / F.lit(100.0)
    profit = scalar.potential_profit(F.col("cashvalue"), F.col("fee"), F.col("bid"))
    return rows.select(
        "auctionid", "bid", "is_bidomatic", rounded(scalar.expected_value(prob, profit)).alias("ev")
    )


def model_values(t: Tables):
    """Both scenarios of the next bid at the end of each auction, by the model."""
    rows = modelled(t)
    states = live.latest_per_auction(
        live.live_states_batch(t.bids, t.auctions, ME).withColumn("seq", F.col("n_bids"))
    )
    # Card types that only the auctions have get a code, too.
    types = F.array(*[F.lit(r.cardtype) for r in t.auctions.select("cardtype").distinct().orderBy("cardtype").collect()])
    categories = rows.unionByName(rows.limit(1).withColumn("cardtype", F.explode(types)))
    users = written(snapshot(t), "snapshot")
    features = live.live_features(states, t.auctions, users, now=F.lit("2024-02-01 12:00:00").cast("timestamp_ntz"), me=ME)
    return live.live_ev(features, fitted(rows, categories)).select("auctionid", "bid", "bom_proba", "manual_proba", "bom_ev", "manual_ev")


def emitted(t: Tables):
    """Rows sent out per auction when every change is reported."""
    return tracked(t, every=True)[0].groupBy("auction_id").agg(F.count("*").alias("rows_out"))


QUERIES = {
    "l01_ingest_stream": ingested,
    "l02_kept_bids": kept,
    "l02_stream_states": streamed_states,
    "l03_gap_flags": lambda t: live.gap_flags(kept(t)),
    "l04_go_live": lambda t: tracked(t)[0].groupBy("auction_id").agg(F.max("is_live").alias("went_live")),
    "l05_next_bid_features": next_bid_features,
    "l05_stream_opponents": streamed_opponents,
    "l06_padding": padded,
    "l07_auction_rows": auction_rows,
    "l08_snapshot_join": with_snapshot,
    "l09_emit_on_change": emitted,
    "l10_current_board": current_board,
    "l10_valued_board": valued_board,
    "l11_state_before_own_bid": own_bids,
    "l11_stream_state_before_own_bid": streamed_own_bids,
    "l12_upcoming_replaced": replaced_upcoming,
    "l13_first_on_board": lambda t: live.first_on_board(
        board(t).withColumn("bom_ev", F.when(F.col("is_live"), F.col("bom_ev")))
    ).select("auction_id", rounded(F.col("bom_ev")).alias("bom_ev")),
    "e13_model_next_bid_values": model_values,
    "m08_two_scenarios": live_values,
}
