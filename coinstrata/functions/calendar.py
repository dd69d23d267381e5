"""Calendar columns from epoch seconds. Days and months ignore the session time zone (UTC)."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def timestamp_of_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def day_of_epoch(seconds: Column) -> Column:
    return F.date_from_unix_date(F.floor(seconds / F.lit(86400)).cast("int"))


def begin_of_day(seconds: Column) -> Column:
    """The first second of the day of ``seconds``."""
    return (F.floor(seconds / F.lit(86400)) * F.lit(86400)).cast("long")


def month_key(day: Column) -> Column:
    """Zero-padded ``yyyy-MM``, so that text order is calendar order."""
    return F.date_format(day, "yyyy-MM")
