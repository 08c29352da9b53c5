"""Raw pages to auctions, bids and upcoming auctions.

Pages are rows of HTML text. Cells are cut out with regular-expression
built-ins, so parsing stays inside the JVM and scales with the rows. A history
page is exploded into its bids straight away; nothing gathers pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.functions.scalar import voucher_value
from gavel.functions.titles import parse_titles, title_fields
from gavel.operators.blocks import block_of

# Marks in the page text.
LIMIT_MARK = "is NOT LIMITED"
SOLD_MARK = 'class="sold"'
LOCK_DIV = '<div id="div_lock_status" style="display: none;">'
OLDER_LOCK_DIV = '<div id="div_lock_prcnt" style="display: none;">'
CELL = r"(?s)<td[^>]*>(.*?)</td>"
UPCOMING_ROW = r'(?s)<tr[^>]*class="[^"]*\btr-inner\b[^"]*"[^>]*>(.*?)</tr>'
AUCTION_ID_TOKEN = r'auction_id=([^"]*)'
# Fixed value: earliest end of a fully tracked auction.
FIRST_DAY = "2019-09-19"


def _cells(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(CELL), F.lit(1))


def _text(cell: Column) -> Column:
    """Visible text of a cell."""
    return F.trim(F.regexp_replace(cell, r"<[^>]*>", ""))


def _seconds(clock: Column) -> Column:
    """Seconds of an H:M:S text."""
    part = F.split(clock, ":")
    return (part[0].cast("int") * 3600 + part[1].cast("int") * 60 + part[2].cast("int")).cast("int")


def store_new_pages(fetched: DataFrame, stored: DataFrame, sold_only: bool = True) -> DataFrame:
    """Fetched pages to add: one per id, sold, and not stored yet."""
    sold = fetched.where(F.col("auction_html").contains(SOLD_MARK)) if sold_only else fetched
    return sold.dropDuplicates(["auction_id"]).join(
        stored.select("auction_id").distinct(), "auction_id", "left_anti"
    )


def unparsed(pages: DataFrame, parsed: DataFrame) -> DataFrame:
    """Pages whose auction is not in the parsed table."""
    ids = parsed.select(F.col("qauctionid").cast("string").alias("auction_id")).distinct()
    return pages.join(ids, "auction_id", "left_anti")


def parse_auctions(pages: DataFrame, lock_div: str = LOCK_DIV) -> DataFrame:
    """Title, limit, tracking, end time, running time and lock price per page."""
    title = F.substring_index(
        F.expr("substring(auction_html, locate(concat(auction_id, ' - '), auction_html) + length(auction_id) + 3)"),
        "</",
        1,
    )
    cells = _cells(F.col("table_html"))
    last_update = F.split_part(cells[1], F.lit("update: "), F.lit(2))
    lock = F.regexp_extract("table_html", lock_div + "([^<]*)<", 1)
    fields = title_fields(F.col("title"))
    return (
        pages.withColumn("title", title)
        .withColumn("f", fields)
        .select(
            F.col("auction_id").cast("long").alias("qauctionid"),
            F.col("f.cardvalue").alias("cardvalue"),
            F.col("f.bidvalue").alias("bidvalue"),
            F.regexp_extract(cells[0], r"([0-9.]+)\s*%", 1).try_cast("double").alias("tracking"),
            F.to_timestamp_ntz(last_update, F.lit("M/d/yyyy h:mm:ss a")).alias("auctiontime"),
            _seconds(F.split_part(cells[3], F.lit("runtime : "), F.lit(2))).alias("runtime"),
            (~F.col("auction_html").contains(LIMIT_MARK)).alias("limited_allowed"),
            F.col("f.cashvalue").alias("cashvalue"),
            F.col("f.cardtype").alias("cardtype"),
            F.when(lock != "", F.floor(lock.try_cast("double") * 100)).cast("int").alias("lock_price"),
        )
    )


def parse_bids(pages: DataFrame) -> DataFrame:
    """One row per bid: after three header cells, four cells make a bid."""
    cells = F.slice(_cells(F.col("history_html")), F.lit(4), F.lit(1 << 30))
    count = F.floor((F.size(cells) + 3) / 4).cast("int")
    numbered = pages.select("auction_id", cells.alias("c"), count.alias("n"))
    at = F.explode(F.when(F.col("n") > 0, F.sequence(F.lit(0), F.col("n") - 1)))
    start = F.col("i") * 4
    return numbered.select("auction_id", "c", at.alias("i")).select(
        F.col("auction_id").cast("long").alias("auctionid"),
        _text(F.col("c")[start]).cast("int").alias("bid"),
        _text(F.col("c")[start + 2]).alias("username"),
        (_text(F.col("c")[start + 3]) == "Bidomatic").alias("is_bidomatic"),
    )


def parse_new(pages: DataFrame, parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Auctions and bids of the pages not parsed before."""
    todo = unparsed(pages, parsed)
    return parse_auctions(todo), parse_bids(todo)


def upcoming_rows(pages: DataFrame) -> DataFrame:
    """Rows of the upcoming-auctions pages, in page order, before any cut."""
    row = F.posexplode(F.regexp_extract_all("html", F.lit(UPCOMING_ROW), F.lit(1))).alias("pos", "row")
    rows = pages.select("page_id", row).withColumn("c", _cells(F.col("row")))
    description = _text(F.col("c")[2])
    limited = description.startswith("L")
    return parse_titles(
        rows.select(
            "page_id",
            "pos",
            _text(F.col("c")[1]).alias("auctionid"),
            limited.alias("limited_allowed"),
            F.when(limited, F.substr(description, F.lit(2))).otherwise(description).alias("title"),
            _text(F.col("c")[3]).alias("clock"),
        ),
        "title",
    )


def parse_upcoming(pages: DataFrame) -> DataFrame:
    """Upcoming auctions up to the first one that is an hour or more away.

    Titles that say nothing are skipped and do not end the list. The cut is the
    lowest position of a far row, one small aggregate per page.
    """
    rows = upcoming_rows(pages).where(F.col("cashvalue").isNotNull())
    cut = rows.where(~F.col("clock").startswith("00")).groupBy("page_id").agg(F.min("pos").alias("cut"))
    near = rows.join(cut, "page_id", "left").where(F.col("cut").isNull() | (F.col("pos") < F.col("cut")))
    part = F.split("clock", ":")
    return near.select(
        "page_id",
        "auctionid",
        "cashvalue",
        "cardvalue",
        "cardtype",
        "bidvalue",
        "limited_allowed",
        (part[1].cast("int") * 60 + part[2].cast("int")).alias("seconds_left"),
    )


def auction_ids(pages: DataFrame, html: str = "html") -> DataFrame:
    """Auction ids linked from group pages."""
    ids = F.explode(F.regexp_extract_all(html, F.lit(AUCTION_ID_TOKEN), F.lit(1)))
    return pages.select("page_id", ids.alias("auction_id"))


def missing_auctions(listed: DataFrame, stored: DataFrame, today: Column) -> DataFrame:
    """Listed auctions of a known kind, ended, recent enough and not stored.

    `listed` has auction_id, title and a date text like "Jan-05" (2020) or
    "Jan-05-21"; the clock after it is ignored.
    """
    day = F.split_part("date_text", F.lit(" "), F.lit(1))
    day = F.when(F.length(day) == 6, F.concat(day, F.lit("-20"))).otherwise(day)
    title = F.col("title")
    known = title.contains("Gift Card") | title.contains("Buster") | title.contains("Voucher")
    cheap = title.contains("$10 ") | title.contains("$15 ")
    after_percent = F.when(title.contains("%"), F.split_part(title, F.lit("%"), F.lit(2))).otherwise(title)
    plain = F.when(after_percent.startswith("L"), F.substr(after_percent, F.lit(2))).otherwise(after_percent)
    wanted = (
        listed.where(known & ~cheap)
        .withColumn("day", F.to_date(day, "MMM-dd-yy"))
        .where((F.datediff(today, "day") > 1) & (F.col("day") >= F.lit("2020-01-01").cast("date")))
    )
    return (
        wanted.join(stored.select("auction_id").distinct(), "auction_id", "left_anti")
        .select("auction_id", plain.alias("title"))
        .distinct()
    )


def missing_by_title(missing: DataFrame) -> DataFrame:
    """How many auctions are missing per title; plain dollar titles are left out."""
    return (
        missing.where(~F.col("title").startswith("$"))
        .groupBy("title")
        .agg(F.count_distinct("auction_id").alias("n"))
    )


def clean_auctions(parsed: DataFrame, stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(auctions to store, ids to exclude): only fully tracked ones are stored."""
    new = parsed
    if stored is not None:
        new = parsed.join(stored.select("qauctionid").distinct(), "qauctionid", "left_anti")
    tracked = (F.col("tracking") == 100) & (F.col("auctiontime") >= F.lit(FIRST_DAY).cast("timestamp_ntz"))
    kept = new.where(tracked).select(
        "qauctionid",
        "cardvalue",
        voucher_value(F.col("cashvalue"), F.col("cardvalue")).alias("bidvalue"),
        "tracking",
        "auctiontime",
        "runtime",
        "limited_allowed",
        "cashvalue",
        "cardtype",
        F.coalesce("lock_price", F.lit(0)).alias("lock_price"),
    )
    excluded = new.where(~F.coalesce(tracked, F.lit(False))).select(F.col("qauctionid").alias("auctionid"))
    return kept, excluded


def clean_bids(parsed: DataFrame, excluded: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Bids to store: not of excluded auctions, nor of auctions already stored."""
    out = parsed.join(excluded.select("auctionid").distinct(), "auctionid", "left_anti")
    if stored is not None:
        out = out.join(stored.select("auctionid").distinct(), "auctionid", "left_anti")
    return out


def with_known_auction(bids: DataFrame, auctions: DataFrame) -> DataFrame:
    """Bids whose auction exists."""
    return bids.join(auctions.select(F.col("qauctionid").alias("auctionid")).distinct(), "auctionid", "left_semi")


def purge(bids: DataFrame, auctions: DataFrame, day: str = FIRST_DAY) -> tuple[DataFrame, DataFrame]:
    """What is left after dropping orphan bids and everything ended by `day`."""
    kept = auctions.where(F.col("auctiontime") > F.lit(day).cast("timestamp_ntz"))
    return with_known_auction(bids, kept), kept


def render_history(bids: DataFrame, per_page: int = 1000) -> DataFrame:
    """History pages that parse back to the given bids, `per_page` bids a page."""
    line = F.concat(
        F.lit("<tr><td>"), F.col("bid").cast("string"), F.lit("</td><td>x</td><td>"), F.col("username"),
        F.lit("</td><td>"), F.when(F.col("is_bidomatic"), "Bidomatic").otherwise("Single"), F.lit("</td></tr>"),
    )
    lines = F.array_sort(F.collect_list(F.struct("bid", line.alias("line"))))
    pages = bids.groupBy("auctionid", block_of(F.col("bid"), per_page).alias("page")).agg(lines.alias("lines"))
    return pages.select(
        F.col("auctionid").cast("string").alias("auction_id"),
        F.concat(
            F.lit("<table><td>Bid</td><td>User</td><td>Type</td>"),
            F.array_join(F.transform("lines", lambda e: e["line"]), ""),
            F.lit("</table>"),
        ).alias("history_html"),
    )


def render_pages(auctions: DataFrame) -> DataFrame:
    """Auction and table pages that parse back to the given auctions."""
    text = F.col("qauctionid").cast("string")
    title = F.concat(
        F.lit("$"), F.col("cardvalue").cast("string"), F.lit(" "), F.col("cardtype"), F.lit(" Gift Card AND "),
        F.col("bidvalue").cast("string"), F.lit(" Bids ($"), F.col("cashvalue").cast("string"), F.lit(")"),
    )
    hours = F.expr("runtime div 3600")
    clock = F.format_string("%d:%d:%d", hours, F.expr("runtime div 60") % 60, F.col("runtime") % 60)
    when = F.date_format("auctiontime", "M/d/yyyy h:mm:ss a")
    lock = F.when(F.col("lock_price") == 0, "").otherwise(
        F.format_string("%d.%02d", F.expr("lock_price div 100"), F.col("lock_price") % 100)
    )
    return auctions.select(
        text.alias("auction_id"),
        F.col("cardtype").alias("auction_group"),
        F.concat(
            F.lit('<h1 class="sold">'), text, F.lit(" - "), title, F.lit("</h1>"),
            F.when(F.col("limited_allowed"), "").otherwise("This auction is NOT LIMITED"),
        ).alias("auction_html"),
        F.concat(
            F.lit("<table><td>Tracking "), F.col("tracking").cast("string"), F.lit("%</td><td>Last update: "), when,
            F.lit("</td><td></td><td>Auction runtime : "), clock, F.lit("</td></table>"), F.lit(LOCK_DIV), lock,
            F.lit("</div>"),
        ).alias("table_html"),
    )
