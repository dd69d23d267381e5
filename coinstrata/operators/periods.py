"""Entities over calendar periods: the category they were in at the time, and timelines that
go on from an opening balance."""

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coinstrata.functions import holder_category_coarse, month_key, rounded_btc, to_btc
from coinstrata.operators.history import balance_timeline
from coinstrata.sources.snapshots import commit, latest
from coinstrata.sources.tables import write_table


def month_ends(daily: DataFrame) -> DataFrame:
    """(entity_id, month, balance_satoshi): an entity's balance at the end of each month in
    which it changed; ``month`` is the first day. Changes of a month are added before the
    window, so that a window partition has one row per active month."""
    monthly = daily.groupBy("entity_id", F.trunc("event_date", "month").alias("month")).agg(
        F.sum("daily_delta").alias("change")
    )
    so_far = Window.partitionBy("entity_id").orderBy("month")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.select(
        "entity_id", "month", F.sum("change").over(so_far).alias("balance_satoshi")
    )


def category_intervals(ends: DataFrame) -> DataFrame:
    """(entity_id, category, first_month, until): while which category held for an entity at
    the ends of months; ``until`` is the month from which another one holds, null for the
    category of today. A category that goes on is one interval, however often the balance
    changed in it."""
    by_month = Window.partitionBy("entity_id").orderBy("month")
    named = ends.withColumn("category", holder_category_coarse(F.col("balance_satoshi")))
    begins = named.withColumn("before", F.lag("category").over(by_month))
    begins = begins.filter(~F.col("category").eqNullSafe(F.col("before")))
    return begins.select(
        "entity_id",
        "category",
        F.col("month").alias("first_month"),
        F.lead("month").over(by_month).alias("until"),
    )


def category_month_end_then(ends: DataFrame) -> DataFrame:
    """(year_month, category, total_btc, entity_count): what the entities of each category
    held at the end of every calendar month, by the category that they were in then.

    An entity moves sums only in months in which it changed: out of the category it was in,
    into the one it is in now. These moves are added up per category and month, and the few
    sums are accumulated, so that no entity is repeated for idle months and an entity with
    many changes is no heavier than any other row.
    """
    by_month = Window.partitionBy("entity_id").orderBy("month")
    before = F.lag(F.struct("balance_satoshi")).over(by_month)
    moves = ends.select("month", "balance_satoshi", before.alias("old")).select(
        "month",
        F.inline(
            F.array(
                F.struct(
                    holder_category_coarse(F.col("balance_satoshi")).alias("category"),
                    F.col("balance_satoshi").alias("value"),
                    F.lit(1).alias("n"),
                ),
                F.struct(
                    F.when(
                        F.col("old").isNotNull(),
                        holder_category_coarse(F.col("old.balance_satoshi")),
                    ).alias("category"),
                    (-F.col("old.balance_satoshi")).alias("value"),
                    F.lit(-1).alias("n"),
                ),
            )
        ),
    )
    monthly = moves.filter("category is not null").groupBy("category", "month").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value"), F.sum("n").alias("n")
    )
    # From here on there are at most four rows per month.
    of_category = Window.partitionBy("category").orderBy("month")
    so_far = of_category.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spans = monthly.select(
        "category",
        "month",
        to_btc(F.sum("value").over(so_far)).alias("total_btc"),
        F.sum("n").over(so_far).alias("entity_count"),
        F.add_months(F.lead("month").over(of_category), -1).alias("before_next"),
        F.max("month").over(whole).alias("last"),
    )
    months = F.sequence("month", F.coalesce("before_next", "last"), F.expr("interval 1 month"))
    return (
        spans.filter("entity_count > 0")
        .select("category", "total_btc", "entity_count", F.explode(months).alias("month"))
        .select(month_key(F.col("month")).alias("year_month"), "category", "total_btc", "entity_count")
    )


def timeline_from(opening: DataFrame, daily: DataFrame) -> DataFrame:
    """The timeline of the days in ``daily``, from ``opening`` balances (entity_id,
    balance_satoshi) of all earlier days; an entity without one begins at 0."""
    ran = balance_timeline(daily).drop("cumulative_btc")
    # One row per entity on the right.
    joined = ran.join(opening, "entity_id", "left")
    total = F.col("cumulative_satoshi") + F.coalesce("balance_satoshi", F.lit(0))
    return joined.select(
        "entity_id", "event_date", "daily_delta", total.alias("cumulative_satoshi"),
        rounded_btc(total, 4).alias("cumulative_btc"),
    )


def closing_balances(opening: DataFrame, daily: DataFrame) -> DataFrame:
    """(entity_id, balance_satoshi) after the days in ``daily``."""
    changes = daily.select("entity_id", F.col("daily_delta").alias("balance_satoshi"))
    return (
        opening.unionByName(changes).groupBy("entity_id").agg(F.sum("balance_satoshi").alias("balance_satoshi"))
    )


class TimelineIndex:
    """Timelines that grow by periods, in ``folder``: one part for each period, and the
    balances at the end of the last one. A new period reads its own days and those balances;
    no earlier day is read again."""

    _OPENING = "entity_id string, balance_satoshi long"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.version, state = latest(spark, self.folder)
        self._state = state or {"parts": [], "balances": None, "last_day": None}

    @property
    def last_day(self) -> dt.date | None:
        day = self._state["last_day"]
        return day and dt.date.fromisoformat(day)

    def balances(self) -> DataFrame:
        path = self._state["balances"]
        if path is None:
            return self.spark.createDataFrame([], self._OPENING)
        return self.spark.read.schema(self._OPENING).parquet(f"{self.folder}/{path}")

    def timeline(self) -> DataFrame:
        """All periods' days, as ``balance_timeline`` over all of them gives."""
        if not self._state["parts"]:
            raise ValueError(f"no period in {self.folder}")
        return self.spark.read.parquet(*[f"{self.folder}/{p}" for p in self._state["parts"]])

    def add(self, daily: DataFrame, last_day: dt.date) -> None:
        """Add a period that ends with ``last_day``: the daily changes after the period
        before it. Days outside the period are an error."""
        bounds = daily.agg(F.min("event_date").alias("low"), F.max("event_date").alias("high")).first()
        late = bounds.high is not None and bounds.high > last_day
        early = bounds.low is not None and self.last_day is not None and bounds.low <= self.last_day
        if late or early or (self.last_day is not None and last_day <= self.last_day):
            raise ValueError(f"days of {bounds.low} to {bounds.high} are not after {self.last_day}, up to {last_day}")
        part = f"period-{uuid.uuid4().hex}"
        opening = self.balances()
        write_table(timeline_from(opening, daily), f"{self.folder}/{part}/timeline")
        write_table(closing_balances(opening, daily), f"{self.folder}/{part}/balances")
        state = {
            "parts": [*self._state["parts"], f"{part}/timeline"],
            "balances": f"{part}/balances",
            "last_day": last_day.isoformat(),
        }
        commit(self.spark, self.folder, self.version + 1, state)
        self.version, self._state = self.version + 1, state
