"""Positions and neighbours in groups of any size.

A window sorts one group in one task. Here rows are dealt out by ranges of (key, order)
instead, which cuts any group where it needs to be cut, and written once with the number of
their range. Windows then run over one group's part of one range, and the few parts of a
group are linked by a small table with one row for each part.
"""

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coinstrata.sources.tables import write_table

# Groups up to this many rows may be sorted in one task.
WINDOW_ROWS = 10_000


def hot_groups(counts: DataFrame, key: str, limit: int) -> DataFrame | None:
    """Keys of ``counts`` (key, n) above ``limit`` rows, or None. Runs one job.

    There are at most rows / limit of them.
    """
    hot = counts.filter(F.col("n") > limit).select(key)
    return None if hot.isEmpty() else hot


def _in_ranges(df: DataFrame, order: list[str], workdir: str) -> DataFrame:
    """``df`` with ``_part``, the number of the row's range by ``order``, written below
    ``workdir``: ranges depend on the sample they are drawn from."""
    dealt = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    return write_table(dealt, f"{workdir}/ranges-{uuid.uuid4().hex}")


def ranked(df: DataFrame, order: list[str], workdir: str, name: str) -> DataFrame:
    """Add ``name``: the position of the row among all rows by ``order``, from 0."""
    dealt = _in_ranges(df, order, workdir)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range reaches this window.
    offsets = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return (
        dealt.withColumn("_inner", inner)
        .join(offsets, "_part")
        .select(*df.columns, (F.col("_inner") + F.col("_offset")).cast("long").alias(name))
    )


def numbered(df: DataFrame, key: str, order: list[str], workdir: str, name: str) -> DataFrame:
    """Add ``name``: the position of the row in its group by ``order``, from 0."""
    dealt = _in_ranges(df, [key, *order], workdir)
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(key, "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    inner = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) - 1
    return (
        dealt.withColumn("_inner", inner)
        .join(offsets, [key, "_part"])
        .select(*df.columns, (F.col("_inner") + F.col("_offset")).cast("long").alias(name))
    )


def with_neighbours(
    df: DataFrame,
    key: str,
    order: list[str],
    carry: list[str],
    workdir: str,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Add ``previous`` and ``following``: structs of ``carry`` from the rows next to this
    one in its group by ``order``, null at the ends. ``order`` must be unique in a group.
    Rows without a key are left out.

    Only groups of more than ``WINDOW_ROWS`` rows are dealt out by ranges, the others are
    shuffled once, to a window. ``sizes`` (key, n) are the rows of each group, if they can be
    told from less than ``df``.
    """
    df = df.filter(F.col(key).isNotNull())
    if sizes is None:
        sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    large = hot_groups(sizes, key, WINDOW_ROWS)
    if large is None:
        return _neighbours_in_window(df, key, order, carry)
    df = write_table(df, f"{workdir}/groups-{uuid.uuid4().hex}")
    usual = df.join(large, key, "left_anti").select(df.columns)
    hot = df.join(large, key, "left_semi").select(df.columns)
    return _neighbours_in_window(usual, key, order, carry).unionByName(
        _neighbours_in_ranges(hot, key, order, carry, workdir)
    )


def _neighbours_in_window(
    df: DataFrame, key: str, order: list[str], carry: list[str]
) -> DataFrame:
    row, group = F.struct(*carry), Window.partitionBy(key).orderBy(*order)
    return df.select(
        "*", F.lag(row).over(group).alias("previous"), F.lead(row).over(group).alias("following")
    )


def _neighbours_in_ranges(
    df: DataFrame, key: str, order: list[str], carry: list[str], workdir: str
) -> DataFrame:
    row, sort_key = F.struct(*carry), F.struct(*order)
    dealt = _in_ranges(df, [key, *order], workdir)
    between = Window.partitionBy(key).orderBy("_part")
    edges = (
        dealt.groupBy(key, "_part")
        .agg(
            F.min_by(row, sort_key).alias("_first"),
            F.max_by(row, sort_key).alias("_last"),
        )
        .select(
            key,
            "_part",
            F.lag("_last").over(between).alias("_before"),
            F.lead("_first").over(between).alias("_after"),
        )
    )
    inside = Window.partitionBy(key, "_part").orderBy(*order)
    return (
        dealt.withColumn("_lag", F.lag(row).over(inside))
        .withColumn("_lead", F.lead(row).over(inside))
        .join(edges, [key, "_part"])
        .withColumn("previous", F.coalesce("_lag", "_before"))
        .withColumn("following", F.coalesce("_lead", "_after"))
        .select(*df.columns, "previous", "following")
    )
