"""Auction titles to product values, with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.functions.scalar import BIDS_PER_DOLLAR

# Face value by the number word of a limit buster, in the order
# in which the words are tried.
BUSTER_VALUES = [("Two", 30), ("One", 15), ("Four", 60)]

TITLE_COLUMNS = ["cashvalue", "cardvalue", "cardtype", "bidvalue"]


def _number(text: Column, kind: str = "int") -> Column:
    """Text to number; anything else gives NULL."""
    return text.try_cast("double").cast(kind)


def _rest(text: Column) -> Column:
    """All but the first character."""
    return F.substr(text, F.lit(2))


def title_fields(title: Column, older: bool = False) -> Column:
    """Struct of cashvalue, cardvalue, cardtype and bidvalue; NULLs when unknown.

    A title reads "<value> <type> Gift Card AND <n> Bids ($<cash>)", or a gift
    card alone, or "<n> Voucher Bids", or a limit buster. Cases are tried in
    that order on the text after the first word. The `older` rules give a card
    alone no bids, take any other bids for vouchers and know no busters.
    """
    lead = F.split_part(title, F.lit(" "), F.lit(1))
    body = F.regexp_extract(title, r"(?s)^[^ ]* (.*)$", 1)
    in_parens = F.split_part(F.split_part(body, F.lit("("), F.lit(2)), F.lit(")"), F.lit(1))
    cashvalue = _number(_rest(in_parens), "double")
    bids, card = body.contains("Bids"), body.contains("Gift Card")
    face = _number(_rest(lead))
    given = _number(
        _rest(F.split_part(F.split_part(body, F.lit(" Gift Card AND"), F.lit(2)), F.lit(" Bids"), F.lit(1)))
    )
    buster = F.lit(None).cast("int")
    for word, value in reversed(BUSTER_VALUES):
        buster = F.when(body.contains(word), F.lit(value)).otherwise(buster)

    def worth(cardvalue: Column) -> Column:
        """Whole voucher bids for what the card leaves of the cash value."""
        return ((cashvalue - cardvalue) * F.lit(BIDS_PER_DOLLAR)).cast("int")

    def fields(cardvalue: Column, cardtype: Column, bidvalue: Column) -> Column:
        return F.struct(
            cashvalue.cast("int").alias("cashvalue"),
            cardvalue.cast("int").alias("cardvalue"),
            cardtype.cast("string").alias("cardtype"),
            bidvalue.cast("int").alias("bidvalue"),
        )

    none = F.struct(
        F.lit(None).cast("int").alias("cashvalue"),
        F.lit(None).cast("int").alias("cardvalue"),
        F.lit(None).cast("string").alias("cardtype"),
        F.lit(None).cast("int").alias("bidvalue"),
    )
    with_bids = fields(face, F.split_part(body, F.lit(" Gift Card AND"), F.lit(1)), given)
    alone_type = F.split_part(body, F.lit(" Gift Card"), F.lit(1))
    vouchers = fields(F.lit(0), F.lit("None"), _number(lead))
    if older:
        alone = fields(face, alone_type, F.lit(0))
        return F.when(bids & card, with_bids).when(card, alone).when(bids, vouchers).otherwise(none)
    return (
        F.when(bids & card, with_bids)
        .when(card, fields(face, alone_type, worth(face)))
        .when(bids & body.contains("Voucher"), vouchers)
        .when(body.contains("Buster") & buster.isNotNull(), fields(buster, F.lit("Buster"), worth(buster)))
        .otherwise(none)
    )


def parse_titles(df: DataFrame, col: str, older: bool = False) -> DataFrame:
    """`df` plus the four product columns read from a title column."""
    return df.withColumn("_t", title_fields(F.col(col), older)).select(
        *df.columns, *[F.col(f"_t.{c}").alias(c) for c in TITLE_COLUMNS]
    )
