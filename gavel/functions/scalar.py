"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Value of one voucher bid in bids per dollar, cost of one bid,
# and the checkout fee by card value.
BIDS_PER_DOLLAR = 2.5
BID_COST = 0.4
BID_CENTS = 40


def ratio(num: Column, den: Column) -> Column:
    """Double division; a zero divisor gives NULL."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def fee(cardvalue: Column) -> Column:
    return F.when(cardvalue == 0, 0.0).when(cardvalue < 50, 1.0).otherwise(1.99)


def is_locked(lock_price: Column, bid: Column) -> Column:
    return (lock_price != 0) & (bid >= lock_price)


def perc_to_bin(bids: Column, cashvalue: Column) -> Column:
    """Share of the buy-it-now price already spent in bids."""
    return ratio(bids, cashvalue * F.lit(BIDS_PER_DOLLAR))


def voucher_value(cashvalue: Column, cardvalue: Column) -> Column:
    """Bids won with the card, rounded half away from zero."""
    return F.round((cashvalue - cardvalue) * F.lit(BIDS_PER_DOLLAR), 0).cast("int")


def time_of_day(ts: Column) -> Column:
    return F.hour(ts)


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def is_weekend(ts: Column) -> Column:
    """True on Sunday only (Monday is 0)."""
    return F.weekday(ts) >= 6


def flag_text(flag: Column) -> Column:
    """'True', 'False' or 'None'."""
    return F.coalesce(F.initcap(flag.cast("string")), F.lit("None"))


def gain_cents(cashvalue: Column, fee_: Column, bid: Column) -> Column:
    """What a won bid brings before its cost, in whole cents: sums of it don't depend on the order of rows."""
    return cashvalue.cast("long") * 100 - F.round(fee_ * 100).cast("long") - bid.cast("long")


def exact_ratio(num: Column, den: Column, places: int = 6) -> Column:
    """num / den of whole numbers, rounded half away from zero in whole numbers; NULL for a zero divisor."""
    wide = lambda x: x.cast("decimal(20,0)")
    scaled = F.abs(wide(num)) * F.lit(2 * 10**places).cast("decimal(10,0)") + wide(den)
    whole = F.call_function("div", scaled, F.nullif(wide(den) * F.lit(2).cast("decimal(1,0)"), F.lit(0).cast("decimal(1,0)")))
    return F.signum(num.cast("double")) * whole.cast("double") / F.lit(float(10**places))


def potential_profit(cashvalue: Column, fee_: Column, bid: Column) -> Column:
    return cashvalue - fee_ - bid / F.lit(100.0) - F.lit(BID_COST)


def actual_profit(won: Column, cashvalue: Column, fee_: Column, bid: Column) -> Column:
    return won.cast("int") * (cashvalue - fee_ - bid / F.lit(100.0)) - F.lit(BID_COST)


def expected_value(prob: Column, potential: Column) -> Column:
    return prob * potential - (F.lit(1.0) - prob) * F.lit(BID_COST)


def grid_below(value: Column, steps: int, strict: bool) -> Column:
    """How many of the points 0/steps, 1/steps, ... lie below `value`.

    `strict` counts points < value, otherwise points <= value. The estimate
    from the product is corrected by one either way, so a value that sits on
    a grid point is placed exactly as a comparison with that point would.
    """
    n = F.lit(float(steps))
    if strict:
        k = F.ceil(value * n)
        k = F.when((k - 1) / n >= value, k - 1).when(k / n < value, k + 1).otherwise(k)
    else:
        k = F.floor(value * n) + 1
        k = F.when((k - 1) / n > value, k - 1).when(k / n <= value, k + 1).otherwise(k)
    return k.cast("long")
