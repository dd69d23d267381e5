"""Shared by the corpus operators: input tables, stage tables, ids that survive joins."""

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coinstrata.session import own_folder
from coinstrata.sources.tables import write_table

#: What counts as white space in the contracts: space, tab to carriage return.
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Stages:
    """Stage tables of one operator call, in a folder of their own that all executors
    share and that goes when the application ends."""

    def __init__(self, spark: SparkSession, kind: str, parent: str | None = None):
        self.folder = own_folder(spark, kind, parent)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        return write_table(df, f"{self.folder}/{name}")


def carried(df: DataFrame, made: list[str]) -> Column:
    """A struct of the columns of ``df`` but those named in ``made``, which an operator
    makes anew. Carried in one column, they cannot clash with an operator's own names."""
    names = {name.lower() for name in made}
    return F.struct(*[df[c] for c in df.columns if c.lower() not in names])


def slices(rows: list, limit: int, size) -> Iterator[list]:
    """``rows`` in runs whose summed ``size`` stays near ``limit``, one row at least."""
    run, held = [], 0
    for row in rows:
        run.append(row)
        held += size(row)
        if held >= limit:
            yield run
            run, held = [], 0
    if run:
        yield run
