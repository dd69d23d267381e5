"""Bucket labels. Label texts and bounds are fixed values."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from coinstrata.functions.amounts import SATOSHI_PER_BTC

# Lower bound in BTC (inclusive) and label, largest first.
HOLDER_CATEGORIES = [
    (1000, "Mega Whale (1000+ BTC)"),
    (100, "Whale (100-1000 BTC)"),
    (10, "Large (10-100 BTC)"),
    (1, "Medium (1-10 BTC)"),
    (None, "Small (<1 BTC)"),
]
HOLDER_CATEGORIES_COARSE = [
    (1000, "Mega Whale (1000+ BTC)"),
    (100, "Whale (100-1000 BTC)"),
    (10, "Large (10-100 BTC)"),
    (None, "Small/Medium (<10 BTC)"),
]
MEGA_LABEL = "Mega Whale (1000+ BTC)"

# Addresses per entity (exclusive lower bound) and likely kind of owner.
SIZE_IDENTITIES = [
    (10_000, "Exchange"),
    (1_000, "Mining pool"),
    (100, "Merchant or service"),
    (10, "Active user or trader"),
    (None, "Casual user"),
]


def _bucket(value: Column, bounds, above) -> Column:
    branches = None
    for bound, label in bounds:
        if bound is None:
            return branches.otherwise(F.lit(label))
        test = above(value, bound)
        branches = F.when(test, label) if branches is None else branches.when(test, label)
    return branches


def _at_least_btc(satoshi: Column, btc: int) -> Column:
    return satoshi >= F.lit(btc * SATOSHI_PER_BTC)


def holder_category(balance_satoshi: Column) -> Column:
    """Five buckets; compared in satoshi, so the bounds are exact."""
    return _bucket(balance_satoshi, HOLDER_CATEGORIES, _at_least_btc)


def holder_category_coarse(balance_satoshi: Column) -> Column:
    """Four buckets, as used by the monthly view."""
    return _bucket(balance_satoshi, HOLDER_CATEGORIES_COARSE, _at_least_btc)


def size_identity(address_count: Column) -> Column:
    return _bucket(address_count, SIZE_IDENTITIES, lambda value, bound: value > F.lit(bound))


def trend_label(cumulative: Column) -> Column:
    return F.when(cumulative > 0, "accumulation").otherwise("distribution")
