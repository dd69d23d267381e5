"""Current balances of addresses and entities, rankings, categories and statistics."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coinstrata.functions import (
    SATOSHI_PER_BTC,
    exact_total,
    holder_category,
    percent,
    ratio,
    to_btc,
)
from coinstrata.functions.labels import MEGA_LABEL
from coinstrata.operators.skew import ranked


def utxo_addresses(utxo_df: DataFrame) -> DataFrame:
    """One row per unspent output and address; outputs without address vanish."""
    return utxo_df.select(
        "tx_hash", "output_index", "value", F.explode("addresses").alias("address")
    )


def address_balances(utxo_df: DataFrame) -> DataFrame:
    """(address, balance_satoshi, utxo_count). Combined in the map tasks, so an address
    that owns a third of the outputs still leaves each task as one row."""
    return (
        utxo_addresses(utxo_df)
        .groupBy("address")
        .agg(F.sum("value").alias("balance_satoshi"), F.count(F.lit(1)).alias("utxo_count"))
    )


def entity_balances(utxo_df: DataFrame, entities: DataFrame) -> DataFrame:
    """(entity_id, balance_satoshi, utxo_count, balance_btc), for entities with outputs.

    Summed per address first: the join with ``entities`` then has one row per address on
    both sides instead of one per output. An output with two addresses counts for both.
    Unordered; sorting belongs to the rankings.
    """
    return (
        address_balances(utxo_df)
        .join(entities, "address")
        .groupBy("entity_id")
        .agg(
            F.sum("balance_satoshi").alias("balance_satoshi"),
            F.sum("utxo_count").alias("utxo_count"),
        )
        .withColumn("balance_btc", to_btc(F.col("balance_satoshi")))
    )


def total_btc(balances: DataFrame) -> DataFrame:
    """One row, one column: BTC over all entities."""
    return balances.agg(to_btc(exact_total(F.col("balance_satoshi"))).alias("total_btc"))


def balance_totals(balances: DataFrame) -> DataFrame:
    """One row: entities with a balance, total BTC and the average per entity."""
    return balances.agg(
        F.count(F.lit(1)).alias("entities_with_balance"),
        to_btc(exact_total(F.col("balance_satoshi"))).alias("total_btc"),
    ).withColumn("average_btc", ratio(F.col("total_btc"), F.col("entities_with_balance")))


def top_holders(balances: DataFrame, k: int = 20) -> DataFrame:
    """The k largest balances with rank and share of the total. Ties: by entity_id.

    The total is a scalar subquery, evaluated once; nothing is joined or broadcast.
    """
    largest = balances.orderBy(F.desc("balance_satoshi"), "entity_id").limit(k)
    # At most k rows reach this unpartitioned window.
    rank = F.row_number().over(Window.orderBy(F.desc("balance_satoshi"), "entity_id"))
    return largest.select(
        rank.alias("rank"),
        "entity_id",
        "balance_satoshi",
        "balance_btc",
        "utxo_count",
        percent(F.col("balance_btc"), total_btc(balances).scalar()).alias("share_pct"),
    )


def top_holder_share(balances: DataFrame, k: int = 20) -> DataFrame:
    """One row: what the k largest hold together and their share of everything."""
    largest = balances.orderBy(F.desc("balance_satoshi"), "entity_id").limit(k)
    return (
        total_btc(largest)
        .select(F.lit(k).alias("k"), F.coalesce("total_btc", F.lit(0.0)).alias("top_btc"))
        .withColumn("top_share_pct", percent(F.col("top_btc"), total_btc(balances).scalar()))
    )


def largest_entity(balances: DataFrame) -> DataFrame:
    """The single largest entity, one row."""
    return (
        balances.orderBy(F.desc("balance_satoshi"), "entity_id")
        .limit(1)
        .select("entity_id", "balance_satoshi", "balance_btc", "utxo_count")
    )


def category_statistics(balances: DataFrame) -> DataFrame:
    """Entities, BTC and outputs per category, with shares. At most five rows."""
    per_category = (
        balances.groupBy(holder_category(F.col("balance_satoshi")).alias("category"))
        .agg(
            F.count(F.lit(1)).alias("entity_count"),
            to_btc(exact_total(F.col("balance_satoshi"))).alias("total_btc"),
            F.sum("utxo_count").alias("total_utxos"),
        )
    )
    totals = balances.agg(
        F.count(F.lit(1)).alias("entities"),
        to_btc(exact_total(F.col("balance_satoshi"))).alias("btc"),
    )
    return per_category.select(
        "category",
        "entity_count",
        "total_btc",
        "total_utxos",
        percent(F.col("entity_count"), totals.select("entities").scalar()).alias("entity_pct"),
        percent(F.col("total_btc"), totals.select("btc").scalar()).alias("btc_pct"),
    ).orderBy(F.desc("total_btc"), "category")


def mega_holder_concentration(balances: DataFrame) -> DataFrame:
    """One row: count, BTC and share of the top category. Share is 0 without balances."""
    is_mega = holder_category(F.col("balance_satoshi")) == F.lit(MEGA_LABEL)
    mega = F.when(is_mega, F.col("balance_satoshi"))
    return balances.agg(
        F.count(mega).alias("mega_count"),
        F.coalesce(to_btc(exact_total(mega)), F.lit(0.0)).alias("mega_btc"),
        F.coalesce(to_btc(exact_total(F.col("balance_satoshi"))), F.lit(0.0)).alias("total_btc"),
    ).withColumn(
        "mega_share_pct",
        F.coalesce(percent(F.col("mega_btc"), F.col("total_btc")), F.lit(0.0)),
    )


def entity_addresses(entities: DataFrame, chosen: DataFrame) -> DataFrame:
    """Addresses of the entities in ``chosen``: a semi-join, no list on the driver."""
    return entities.join(chosen.select("entity_id"), "entity_id", "left_semi")


def holder_addresses(utxo_df: DataFrame, entities: DataFrame, chosen: DataFrame) -> DataFrame:
    """Balance of each address of the chosen entities; addresses without outputs drop out.

    Only their outputs are summed. Unordered: an entity may own a large part of all
    addresses. See ``top_addresses``.
    """
    members = entity_addresses(entities, chosen).select("address")
    owned = utxo_addresses(utxo_df).join(members, "address", "left_semi")
    sums = owned.groupBy("address").agg(
        F.sum("value").alias("balance_satoshi"), F.count(F.lit(1)).alias("utxo_count")
    )
    return sums.select(
        "address",
        "balance_satoshi",
        "utxo_count",
        to_btc(F.col("balance_satoshi")).alias("balance_btc"),
    )


def top_addresses(balances_by_address: DataFrame, k: int = 10) -> DataFrame:
    """The k addresses holding most."""
    return balances_by_address.orderBy(F.desc("balance_satoshi"), "address").limit(k)


def balance_statistics(balances: DataFrame, workdir: str) -> DataFrame:
    """Minimum, exact median, mean, maximum and sample deviation over all balances.

    The median is that of the middle one or two rows by rank; ``ranked`` numbers the rows
    over range partitions, so no task holds more than one of them.
    """
    btc = F.col("balance_btc")
    totals = balances.agg(
        F.count(F.lit(1)).alias("entity_count"),
        F.min(btc).alias("min_btc"),
        ratio(
            exact_total(F.col("balance_satoshi")),
            F.count(F.lit(1)) * F.lit(SATOSHI_PER_BTC),
        ).alias("mean_btc"),
        F.max(btc).alias("max_btc"),
        F.round(F.stddev_samp(btc), 4).alias("stddev_btc"),
    )
    rows = balances.filter(btc.isNotNull()).select("balance_btc", "entity_id")
    place = ranked(rows, ["balance_btc", "entity_id"], workdir, "place")
    count = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    middle = place.filter(
        F.col("place").between(F.floor((count - 1) / 2), F.ceil((count - 1) / 2))
    )
    median = middle.agg(F.avg("balance_btc").alias("median_btc"))
    return totals.select(
        "entity_count", "min_btc", median.scalar().alias("median_btc"), "mean_btc", "max_btc",
        "stddev_btc",
    )


def equal_width_histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts per equal-width bin of a whole-number column, empty bins included.

    Bins run from the minimum to the maximum, the last one closed. If both are equal the
    range is widened by one half on each side. Bins are found by whole-number division, so
    a value next to a bound falls on its own side of it. The bounds are known before the
    values are read again; counts combine in the map tasks, so ``bins`` rows are shuffled
    per task at most.
    """
    bounds = df.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    empty = df.sparkSession.range(0 if bounds["low"] is None else bins)
    frame = empty.select(F.col("id").cast("int").alias("bin"))
    low, high = bounds["low"] or 0, bounds["high"] or 0
    value = F.col(column).cast("decimal(20,0)")
    position = F.lit(bins // 2)
    if high > low:
        # 38 digits hold a long times a thousand bins.
        steps = (value - F.lit(low).cast("decimal(20,0)")).cast("decimal(28,0)") * F.lit(bins)
        width = F.lit(high).cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")
        position = F.least(F.call_function("div", steps, width).cast("int"), F.lit(bins - 1))
    counts = (
        df.filter(F.col(column).isNotNull())
        .select(position.alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("entity_count"))
    )
    spread = 0.0 if high > low else 0.5
    start = F.lit(float(low) - spread)
    step = F.lit((float(high) + spread - (float(low) - spread)) / bins)
    return frame.join(counts, "bin", "left").select(
        "bin",
        (start + F.col("bin") * step).alias("bin_start"),
        (start + (F.col("bin") + 1) * step).alias("bin_end"),
        F.coalesce("entity_count", F.lit(0)).alias("entity_count"),
    )
