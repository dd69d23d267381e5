"""Loaders for nested JSON exports.

Layout: ``<base>/<batch>/{transactions,blocks}/date=YYYY-MM-DD/*.json``, one record a line.

A line that was torn, that has a value of another type than its field, or that lacks the key
of its record (a transaction's hash, a block's number) is bad. With ``bad_lines="drop"`` it
is no record, and ``quarantined`` gives it back with its file; ``"keep"`` reads what can be
read of it, null fields and all; ``"fail"`` ends the read.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from coinstrata.functions import day_of_epoch, timestamp_of_epoch
from coinstrata.schemas import BLOCK_SCHEMA, SLIM_TRANSACTION_SCHEMA, TRANSACTION_SCHEMA
from coinstrata.sources.files import exists, visible_folders


def load_transactions(
    spark: SparkSession,
    base_path: str,
    use_schema: bool = True,
    start_date: str | None = None,
    end_date: str | None = None,
    slim: bool = False,
    bad_lines: str = "drop",
) -> DataFrame:
    """Transactions of all batches, with ``date`` and ``block_datetime``.

    ``start_date`` and ``end_date`` (inclusive) prune ``date=`` folders before reading.
    ``slim`` leaves out scripts and everything else no operator uses while parsing.
    """
    batches = visible_folders(spark, base_path)
    if not batches:
        raise ValueError(f"no batch folder in {base_path}")
    schema = SLIM_TRANSACTION_SCHEMA if slim else TRANSACTION_SCHEMA
    return _read_batches(
        spark, batches, "transactions", schema if use_schema else None, "block_timestamp",
        (start_date, end_date), bad_lines,
    ).withColumn("block_datetime", timestamp_of_epoch(F.col("block_timestamp")))


def first_part() -> Column:
    """Whether a record is the first or only one of its transaction."""
    return F.coalesce("record_part", F.lit(0)) == 0


def load_blocks(
    spark: SparkSession,
    base_path: str,
    use_schema: bool = True,
    start_date: str | None = None,
    end_date: str | None = None,
    bad_lines: str = "drop",
) -> DataFrame:
    """Blocks of all batches, with ``date`` and ``timestamp_dt``."""
    batches = visible_folders(spark, base_path)
    return _read_batches(
        spark, batches, "blocks", BLOCK_SCHEMA if use_schema else None, "timestamp",
        (start_date, end_date), bad_lines,
    ).withColumn("timestamp_dt", timestamp_of_epoch(F.col("timestamp")))


#: The field that names a record; one without it is of no use to any operator.
_KEYS = {"transactions": "hash", "blocks": "number"}
#: Where the reader puts the text of a line that is no record of the schema.
_BAD = "_bad_line"
_MODES = {"drop": "PERMISSIVE", "keep": "PERMISSIVE", "fail": "FAILFAST"}


def _roots(spark: SparkSession, batches: list[str], kind: str) -> list[str]:
    roots = [f"{batch}/{kind}" for batch in batches]
    roots = [root for root in roots if exists(spark, root)]
    if not roots:
        raise ValueError(f"no {kind}/ folder in any batch")
    return roots


def _read_batches(
    spark: SparkSession,
    batches: list[str],
    kind: str,
    schema: StructType | None,
    seconds: str,
    dates: tuple[str | None, str | None],
    bad_lines: str,
) -> DataFrame:
    """One reader per batch: ``date=`` folders below several roots in a single reader are
    rejected as conflicting partition layouts. Without a schema, one is inferred over the
    files of all batches, so that the batches agree.

    Each batch is filtered by itself: by its folders where it has them, which prunes the
    scan, and by the day of ``seconds`` where a row has no folder's date."""
    if bad_lines not in _MODES:
        raise ValueError(f"bad_lines must be one of {', '.join(_MODES)}")
    roots = _roots(spark, batches, kind)
    reader = spark.read.option("mode", _MODES[bad_lines]).option("columnNameOfCorruptRecord", _BAD)
    if schema is None:
        schema = reader.option("recursiveFileLookup", "true").json(roots).schema
        reader = reader.option("recursiveFileLookup", "false")
    fields = StructType([f for f in schema.fields if f.name != _BAD])
    tables = []
    for root in roots:
        if bad_lines == "drop":
            table = _good_lines(spark.read.text(root), fields, _KEYS[kind])
        else:
            table = reader.schema(fields).json(root)
        tables.append(_dated(table, seconds, *dates))
    return reduce(DataFrame.unionByName, tables)


def _record(line: str, schema: StructType) -> Column:
    """A line as a record, with its text in ``_BAD`` if some field cannot hold its value."""
    fields = [StructField(f.name, f.dataType) for f in schema.fields]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    return F.from_json(line, StructType([*fields, StructField(_BAD, StringType())]), options)


def _good_lines(lines: DataFrame, schema: StructType, key: str) -> DataFrame:
    """The records of good lines. All fields are parsed, whichever are asked for: the file
    reader looks only at those, so what is bad would depend on the query. The generator
    keeps a line from being parsed for the filter and for the fields again."""
    more = [c for c in lines.columns if c != "value"]
    read = lines.filter(F.trim("value") != "")
    read = read.select(F.inline(F.array(_record("value", schema))), *more)
    return read.filter(F.col(_BAD).isNull() & F.col(key).isNotNull()).drop(_BAD)


def quarantined(
    spark: SparkSession, base_path: str, kind: str = "transactions", schema: StructType | None = None
) -> DataFrame:
    """(file, reason, line): the lines of an export that ``load_transactions`` or
    ``load_blocks`` (``kind="blocks"``) leave out. The reason is ``torn`` for what is no
    JSON, ``mistyped`` for a value that its field cannot hold, ``no key`` for a record
    without hash or number. Blank lines are no lines."""
    schema = schema or {"transactions": TRANSACTION_SCHEMA, "blocks": BLOCK_SCHEMA}[kind]
    roots = _roots(spark, visible_folders(spark, base_path), kind)
    lines = spark.read.option("recursiveFileLookup", "true").text(roots)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    read = lines.filter(F.trim("line") != "").withColumn("r", _record("line", schema))
    reason = (
        F.when(F.try_parse_json("line").isNull(), "torn")
        .when(F.col(f"r.{_BAD}").isNotNull() | F.col("r").isNull(), "mistyped")
        .when(F.col(f"r.{_KEYS[kind]}").isNull(), "no key")
    )
    return read.withColumn("reason", reason).filter("reason is not null").select("file", "reason", "line")


def quarantine_counts(bad: DataFrame) -> DataFrame:
    """(file, reason, lines): how many lines of each file are in quarantine, and why."""
    return bad.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("lines"))


def _dated(df: DataFrame, seconds: str, start_date: str | None, end_date: str | None) -> DataFrame:
    """``df`` with a ``date`` in every row, between the two days."""
    limits = [
        (Column.__ge__, start_date),
        (Column.__le__, end_date),
    ]
    tests = [(test, F.lit(day).cast("date")) for test, day in limits if day is not None]
    date = day_of_epoch(F.col(seconds))
    if "date" in df.columns:
        for test, limit in tests:  # on the folders alone; one without a date may hold any day
            df = df.filter(test(F.col("date"), limit) | F.col("date").isNull())
        date = F.coalesce("date", date)
    df = df.withColumn("date", date)
    for test, limit in tests:
        df = df.filter(test(F.col("date"), limit))
    return df
