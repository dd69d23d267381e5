"""Result tables laid out for looking up a few keys.

A table of addresses or entities in no order has every key's rows anywhere, so a question
about one entity reads all of it. Clustered by the key, a row group holds a short range of
keys and says which in its statistics; a bloom filter in each file tells whether a key within
the range is there at all. A few keys are then given to the scan as values, not as a table to
join with, so that it opens the row groups that can have them.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that are given to the scan as values; more are joined.
FEW_KEYS = 1000


def write_lookup(
    df: DataFrame, path: str, key: str, distinct_keys: int = 1_000_000, files: int | None = None
) -> DataFrame:
    """Write ``df`` clustered by ``key`` and return the table. Files are ranges of keys, as
    many as the session has shuffle partitions unless ``files`` is given; a key of many rows
    may go over several. ``distinct_keys`` of a file is what its bloom filter is made for."""
    dealt = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    writer = dealt.sortWithinPartitions(key).write.mode("overwrite")
    writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", str(distinct_keys))
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(table: DataFrame, key: str, keys: DataFrame, few: int = FEW_KEYS) -> DataFrame:
    """The rows of ``table`` whose ``key`` is among ``keys`` (one column). Runs ``keys`` to
    see how many there are: at most ``few`` come to the driver, a larger set is joined. Null
    keys find nothing; repeated ones find each row once."""
    (name,) = keys.columns
    wanted = keys.filter(F.col(name).isNotNull()).distinct()
    held = [row[0] for row in wanted.limit(few + 1).collect()]
    if len(held) <= few:
        return table.filter(F.col(key).isin(held)) if held else table.limit(0)
    return table.join(wanted.withColumnRenamed(name, key), key, "left_semi").select(table.columns)
