"""Balances over time: output history, signed events, daily timeline, monthly views."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coinstrata.functions import (
    SATOSHI_PER_BTC,
    day_of_epoch,
    first_of,
    holder_category_coarse,
    month_key,
    rounded_btc,
    to_btc,
    trend_label,
)
from coinstrata.operators.utxo import compute_utxo_set, spend_references


def utxo_history(
    outputs_df: DataFrame, inputs_df: DataFrame, entities: DataFrame
) -> DataFrame:
    """Outputs of known entities with creation and spending time (null = unspent).

    The left join of outputs with spends is made of an inner join and an anti-join: both
    can be split where a key is skewed. A reference repeated by several inputs repeats
    the output.
    """
    spends = spend_references(inputs_df, F.col("block_timestamp").alias("spent_timestamp"))
    spent = outputs_df.join(spends, ["tx_hash", "output_index"])
    return owned_history(spent, compute_utxo_set(outputs_df, inputs_df), entities)


def owned_history(spent: DataFrame, unspent: DataFrame, entities: DataFrame) -> DataFrame:
    """History from spent outputs (with ``spent_timestamp``) and unspent ones.

    An output belongs to the entity of its first address.
    """
    columns = ["tx_hash", "output_index", "value", "addresses", "block_timestamp"]
    never = F.lit(None).cast("long").alias("spent_timestamp")
    outputs = spent.select(*columns, "spent_timestamp").unionByName(
        unspent.select(*columns, never)
    )
    return (
        outputs.withColumn("address", first_of(F.col("addresses")))
        .filter(F.col("address").isNotNull())
        .join(entities, "address")
        .select(
            "tx_hash",
            "output_index",
            "value",
            "address",
            "entity_id",
            F.col("block_timestamp").alias("created_timestamp"),
            "spent_timestamp",
        )
    )


def history_counts(history: DataFrame) -> DataFrame:
    """One row: outputs with an entity, spent and unspent."""
    return history.agg(
        F.count(F.lit(1)).alias("total_outputs"), F.count("spent_timestamp").alias("spent_outputs")
    ).withColumn("unspent_outputs", F.col("total_outputs") - F.col("spent_outputs"))


def balance_events(history: DataFrame) -> DataFrame:
    """Signed bookings: +value when created, -value when spent. One pass over history."""
    created = F.struct(
        F.col("created_timestamp").alias("at"),
        F.col("value").alias("delta"),
        F.lit("CREATED").alias("event_type"),
    )
    spent = F.struct(
        F.col("spent_timestamp").alias("at"),
        (-F.col("value")).alias("delta"),
        F.lit("SPENT").alias("event_type"),
    )
    events = F.when(F.col("spent_timestamp").isNull(), F.array(created)).otherwise(
        F.array(created, spent)
    )
    return history.select("entity_id", F.inline(events)).select(
        "entity_id", day_of_epoch(F.col("at")).alias("event_date"), "delta", "event_type"
    )


def event_counts(events: DataFrame) -> DataFrame:
    """Bookings per type."""
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))


def daily_changes(events: DataFrame) -> DataFrame:
    """Net change per entity and day, with its positive and negative part.

    Combined in the map tasks: after this an entity has at most one row per calendar day.
    """
    delta = F.col("delta")
    # The net change is both parts together, null where no change is known: one sum less to move.
    parts = events.groupBy("entity_id", "event_date").agg(
        F.max(delta.isNotNull()).alias("known"),
        F.sum(F.when(delta > 0, delta).otherwise(0)).alias("daily_inflow"),
        F.sum(F.when(delta < 0, delta).otherwise(0)).alias("daily_outflow"),
    )
    net = F.when(F.col("known"), F.col("daily_inflow") + F.col("daily_outflow"))
    return parts.select(
        "entity_id", "event_date", net.alias("daily_delta"), "daily_inflow", "daily_outflow"
    )


def balance_timeline(daily: DataFrame) -> DataFrame:
    """Running balance per entity. A window partition is one row per active day."""
    so_far = (
        Window.partitionBy("entity_id")
        .orderBy("event_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.select(
        "entity_id",
        "event_date",
        "daily_delta",
        F.sum("daily_delta").over(so_far).alias("cumulative_satoshi"),
    ).withColumn("cumulative_btc", rounded_btc(F.col("cumulative_satoshi"), 4))


def timeline_counts(timeline: DataFrame) -> DataFrame:
    """One row: timeline rows and entities with a history."""
    per_entity = timeline.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
    return per_entity.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("timeline_rows"),
        F.count(F.lit(1)).alias("entity_count"),
    )


def holder_days(daily: DataFrame, balances: DataFrame, k: int) -> DataFrame:
    """Daily changes of the entities with the k largest current balances."""
    chosen = balances.orderBy(F.desc("balance_satoshi"), "entity_id").limit(k)
    return daily.join(chosen.select("entity_id"), "entity_id", "left_semi")


def holder_trajectories(daily: DataFrame, balances: DataFrame, k: int = 5) -> DataFrame:
    """Timelines of the k largest current balances.

    Days are filtered before the running sum, so only k entities reach the window.
    """
    timeline = balance_timeline(holder_days(daily, balances, k))
    return timeline.select("entity_id", "event_date", "cumulative_btc")


def _with_category(df: DataFrame, balances: DataFrame) -> DataFrame:
    return df.join(
        balances.select(
            "entity_id", holder_category_coarse(F.col("balance_satoshi")).alias("category")
        ),
        "entity_id",
    )


def category_by_month(timeline: DataFrame, balances: DataFrame) -> DataFrame:
    """Sum of all daily balances within a month per current category.

    An entity counts once per active day of the month, with the balance after that day.
    Amounts are added as decimals, so the sum does not depend on their order.
    """
    return (
        _with_category(timeline, balances)
        .groupBy(month_key(F.col("event_date")).alias("year_month"), "category")
        .agg(
            F.sum(F.col("cumulative_btc").cast("decimal(20,4)")).cast("double").alias("total_btc")
        )
        .orderBy("year_month", "category")
    )


def category_month_end(daily: DataFrame, balances: DataFrame) -> DataFrame:
    """Balance per current category at the end of every calendar month.

    A month-end balance is the running sum of all earlier net changes, so changes are
    added per category and month first and only those few rows are accumulated; no
    entity is repeated for months without activity.
    """
    monthly = (
        _with_category(daily, balances)
        .groupBy("category", F.trunc("event_date", "month").alias("month"))
        .agg(F.sum("daily_delta").alias("change"))
    )
    # From here on there are at most four rows per month.
    by_month = Window.partitionBy("category").orderBy("month")
    so_far = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spans = monthly.select(
        "category",
        "month",
        to_btc(F.sum("change").over(so_far)).alias("total_btc"),
        F.add_months(F.lead("month").over(by_month), -1).alias("before_next"),
        F.max("month").over(whole).alias("last"),
    )
    months = F.sequence("month", F.coalesce("before_next", "last"), F.expr("interval 1 month"))
    return spans.select("category", "total_btc", F.explode(months).alias("month")).select(
        month_key(F.col("month")).alias("year_month"), "category", "total_btc"
    )


def holder_monthly_flow(daily: DataFrame, balances: DataFrame, min_btc: int = 100) -> DataFrame:
    """Net change, inflows and outflows per month of all entities holding min_btc or more."""
    large = balances.filter(F.col("balance_satoshi") >= F.lit(min_btc * SATOSHI_PER_BTC))
    monthly = (
        daily.join(large.select("entity_id"), "entity_id", "left_semi")
        .groupBy(month_key(F.col("event_date")).alias("year_month"))
        .agg(
            F.sum("daily_delta").alias("net_change_satoshi"),
            F.sum("daily_inflow").alias("inflows"),
            F.sum("daily_outflow").alias("outflows"),
        )
    )
    return monthly.select(
        "*",
        rounded_btc(F.col("net_change_satoshi"), 2).alias("net_change_btc"),
        rounded_btc(F.col("inflows"), 2).alias("inflows_btc"),
        rounded_btc(F.col("outflows"), 2).alias("outflows_btc"),
    ).orderBy("year_month")


def holder_trend(monthly_flow: DataFrame, months: int = 24) -> DataFrame:
    """Running net change over the last active months, and which way it ends."""
    recent = monthly_flow.orderBy(F.desc("year_month")).limit(months)
    # At most ``months`` rows reach these unpartitioned windows.
    so_far = Window.orderBy("year_month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    whole = Window.orderBy("year_month").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    net = F.col("net_change_btc").cast("decimal(20,2)")
    return recent.select(
        "year_month",
        "net_change_btc",
        "inflows_btc",
        "outflows_btc",
        F.sum(net).over(so_far).cast("double").alias("cumulative_net_btc"),
        trend_label(F.sum(net).over(whole)).alias("trend"),
    ).orderBy("year_month")
