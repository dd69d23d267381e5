"""Parquet tables: result sinks, and stage tables that are written once and re-read."""

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and return the written table: the plan behind ``df`` is cut off."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_counted(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """The written table and its number of rows, counted while it is written."""
    seen = Observation()
    table = write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return table, seen.get["rows"]


def save_results(base_path: str, **tables: DataFrame) -> dict[str, str]:
    """Write each table to ``<base_path>/<name>.parquet``, replacing earlier results."""
    paths = {name: f"{base_path.rstrip('/')}/{name}.parquet" for name in tables}
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(paths[name])
    return paths


def load_results(spark: SparkSession, base_path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base_path.rstrip('/')}/{name}.parquet")


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write ``df`` in buckets of ``keys`` and return the table. A join of two tables with
    as many buckets of the same types of keys needs no shuffle. The catalog of the session
    knows the table under a name of its own; its files are those below ``path``."""
    name = f"bucketed_{uuid.uuid4().hex}"
    # One task per bucket, so that a bucket is one file.
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
