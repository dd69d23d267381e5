"""Column expressions shared by the operators; all of them stay inside the JVM."""

from coinstrata.functions.amounts import (
    SATOSHI_PER_BTC,
    exact_total,
    percent,
    ratio,
    rounded_btc,
    to_btc,
)
from coinstrata.functions.arrays import first_of, preferred_address, zip_fields
from coinstrata.functions.calendar import begin_of_day, day_of_epoch, month_key, timestamp_of_epoch
from coinstrata.functions.labels import (
    holder_category,
    holder_category_coarse,
    size_identity,
    trend_label,
)

__all__ = [
    "SATOSHI_PER_BTC",
    "begin_of_day",
    "day_of_epoch",
    "exact_total",
    "first_of",
    "holder_category",
    "holder_category_coarse",
    "month_key",
    "percent",
    "preferred_address",
    "ratio",
    "rounded_btc",
    "size_identity",
    "timestamp_of_epoch",
    "to_btc",
    "trend_label",
    "zip_fields",
]
