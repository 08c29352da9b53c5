"""Page and message parsing, on pages rendered from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.catalog.tables import MIDWAY, Tables
from gavel.functions.titles import parse_titles
from gavel.sources import pages
from gavel.streaming import feed

ROWS_PER_PAGE = 20


def titles(t: Tables):
    """One title per part, in all the forms a title takes."""
    size, kind = F.col("p_size"), F.col("p_partkey") % 6
    text = size.cast("string")
    word = F.element_at(F.array(*[F.lit(w) for w in ("Two", "One", "Four", "Six")]), (size % 4 + 1).cast("int"))
    card = F.concat(F.lit("$"), text, F.lit(" "), F.col("p_brand"), F.lit(" Gift Card"))
    title = (
        F.when(kind == 0, F.concat(card, F.lit(" AND "), (size * 2).cast("string"), F.lit(" Bids ($"), (size + 10).cast("string"), F.lit(")")))
        .when(kind == 1, F.concat(card, F.lit(" ($"), (size + 3).cast("string"), F.lit(")")))
        .when(kind == 2, F.concat(text, F.lit(" Voucher Bids ($"), (size + 1).cast("string"), F.lit(")")))
        .when(kind == 3, F.concat(F.lit("The "), word, F.lit(" Buster ($"), (size + 40).cast("string"), F.lit(")")))
        .when(kind == 4, F.concat(F.lit("$5 "), F.col("p_name"), F.lit(" ($5)")))
        .otherwise(F.concat(card, F.lit(" ($"), (size + 3).cast("string"), F.lit(".99)")))
    )
    return t.raw("part").select("p_partkey", "p_size", title.alias("title"))


def upcoming_pages(t: Tables):
    """Upcoming pages of twenty rows each, from the titles."""
    minutes, seconds = F.col("p_size") * 3 % 100, F.col("p_size") % 60
    clock = F.format_string("%02d:%02d:%02d", F.expr("p_size * 3 div 100"), minutes % 60, seconds)
    row = F.concat(
        F.lit('<tr class="tr-inner"><td>x</td><td><a href="#">'), F.col("p_partkey").cast("string"),
        F.lit("</a></td><td>"), F.when(F.col("p_size") % 2 == 0, "L").otherwise(""), F.col("title"),
        F.lit("</td><td>"), clock, F.lit("</td></tr>"),
    )
    rows = F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("row"))))
    return (
        titles(t)
        .groupBy(F.expr(f"p_partkey div {ROWS_PER_PAGE}").alias("page_id"))
        .agg(F.array_join(F.transform(rows, lambda e: e["row"]), "\n").alias("html"))
    )


def group_pages(t: Tables):
    """Listing pages of fifty auctions with their links."""
    link = F.concat(F.lit('<a href="x?auction_id='), F.col("qauctionid").cast("string"), F.lit('">go</a>'))
    return t.auctions.groupBy(F.expr("qauctionid div 50").alias("page_id")).agg(
        F.array_join(F.array_sort(F.collect_list(link)), "").alias("html")
    )


def listing(t: Tables):
    """What a user's auction list shows: id, title and an end date."""
    kind = F.col("qauctionid") % 4
    base = F.concat(F.lit("$"), (F.col("cardvalue") + 5).cast("string"), F.lit(" Gift Card"))
    title = (
        F.when(kind == 0, F.concat(F.lit("50%L"), F.col("bidvalue").cast("string"), F.lit(" Voucher Bids")))
        .when(kind == 1, F.lit("LThe One Buster"))
        .when(kind == 2, base)
        .otherwise(F.lit("$10 Gift Card"))
    )
    day = F.when(F.col("qauctionid") % 3 == 0, F.date_format("auctiontime", "MMM-dd")).otherwise(
        F.date_format("auctiontime", "MMM-dd-yy")
    )
    return t.auctions.select(
        F.col("qauctionid").cast("string").alias("auction_id"),
        title.alias("title"),
        F.concat(day, F.lit(" 10:30")).alias("date_text"),
    )


def stored_ids(t: Tables):
    return t.auctions.where(F.col("limited_allowed")).select(F.col("qauctionid").cast("string").alias("auction_id"))


def missing(t: Tables):
    return pages.missing_auctions(listing(t), stored_ids(t), F.lit("2024-01-25").cast("date"))


def messages(t: Tables):
    return feed.render_feed(t.bids)


def all_kinds(t: Tables):
    """Messages of every kind: bids, sold, countdowns, empty and broken ones."""
    key = F.col("qauctionid").cast("string")
    n = F.col("qauctionid") % 6
    body = (
        F.when(n == 0, '{"sl":3,"s":"x","bh":[{"id":1,"u":"a","t":2}]}')
        .when(n == 1, '{"sl":3,"bh":[{"id":1,"u":"a","t":2}]}')
        .when(n == 2, F.concat(F.lit('{"sl":'), (F.col("runtime") % 40).cast("string"), F.lit("}")))
        .when(n == 3, '{"sl":12}')
        .when(n == 4, "{}")
        .otherwise("5")
    )
    return t.auctions.select(
        F.col("qauctionid").alias("seq"),
        F.concat(F.lit('cb({"a":{"'), key, F.lit('":'), body, F.lit("}})")).alias("message"),
    )


def unwrapped(t: Tables):
    text = feed.unwrap(F.col("message"))
    return messages(t).select("seq", F.json_object_keys(F.get_json_object(text, "$.a"))[0].alias("auction_id"))


def parse_remaining(t: Tables):
    rendered = pages.render_pages(t.auctions)
    known = t.auctions.where(F.col("auctiontime") < F.lit(MIDWAY).cast("timestamp_ntz"))
    return pages.parse_auctions(pages.unparsed(rendered, known)).select("qauctionid", "cashvalue", "cardtype")


QUERIES = {
    "p01_titles": lambda t: parse_titles(titles(t), "title").drop("title", "p_size"),
    "p01_titles_older": lambda t: parse_titles(titles(t), "title", older=True).drop("title", "p_size"),
    "p02_auction_pages": lambda t: pages.parse_auctions(pages.render_pages(t.auctions)).select(
        "qauctionid", "cashvalue", "cardvalue", "bidvalue", "cardtype", "limited_allowed"
    ),
    "p03_table_pages": lambda t: pages.parse_auctions(pages.render_pages(t.auctions)).select(
        "qauctionid", "tracking", "auctiontime", "runtime", "lock_price"
    ),
    "p04_history_pages": lambda t: pages.parse_bids(pages.render_history(t.bids)),
    "p05_upcoming_pages": lambda t: pages.parse_upcoming(upcoming_pages(t)),
    "p06_parse_new_only": parse_remaining,
    "p07_auction_ids": lambda t: pages.auction_ids(group_pages(t)),
    "p08_missing_auctions": missing,
    "p08_missing_by_title": lambda t: pages.missing_by_title(missing(t)),
    "p09_unwrap_messages": unwrapped,
    "p10_classify_messages": lambda t: feed.classify(all_kinds(t)).select("seq", "auction_id", "kind"),
    "p11_feed_bids": lambda t: feed.feed_bids(feed.parse_feed(messages(t))).drop("sl"),
    "p11_newest_bids": lambda t: feed.feed_bids(feed.parse_feed(messages(t)), newest_only=True).drop("sl", "pos"),
}
