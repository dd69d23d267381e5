"""Amounts: integer satoshi is the exact column, BTC is a double for display."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SATOSHI_PER_BTC = 100_000_000  # fixed value


def to_btc(satoshi: Column) -> Column:
    """Satoshi as BTC. One division of an integer is already the double nearest to the
    8-decimal amount, so rounding to 8 places afterwards would change nothing."""
    return satoshi.cast("double") / F.lit(float(SATOSHI_PER_BTC))


def rounded_btc(satoshi: Column, digits: int) -> Column:
    return F.round(to_btc(satoshi), digits)


def exact_total(satoshi: Column) -> Column:
    """Exact sum of longs that may leave the long range once a whole ledger is added up."""
    return F.sum(satoshi.cast("decimal(19,0)"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, null when whole is 0 or null (ANSI mode would raise)."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)
