"""Exports that grow: every file is read once.

A folder's files are followed by Structured Streaming: its checkpoint is the manifest of the
files that were read, by path and time of change. Each run takes what is new, late batches
and late days included, and ends. The records of a run are written under the number that
the checkpoint gave it; a run that was interrupted is done again under the same number and
replaces what it had written, so no file's records are there twice.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from coinstrata.functions import day_of_epoch, timestamp_of_epoch
from coinstrata.schemas import BLOCK_SCHEMA, SLIM_TRANSACTION_SCHEMA
from coinstrata.sources.files import exists

_KINDS = {
    "transactions": (SLIM_TRANSACTION_SCHEMA, "hash", "block_timestamp", "block_datetime"),
    "blocks": (BLOCK_SCHEMA, "number", "timestamp", "timestamp_dt"),
}
_BAD = "_bad_line"


def ingest(
    spark: SparkSession, base_path: str, target: str, kind: str = "transactions",
    files_per_run: int | None = None,
) -> int:
    """Read the files of ``<base>/<batch>/<kind>`` that are new since the last call into the
    table below ``target``, and return the number of runs it took. ``files_per_run`` bounds
    what one run reads. Bad lines go to a table of their own, see ``ingested_bad_lines``."""
    schema, key, seconds, _ = _KINDS[kind]
    target = target.rstrip("/")
    fields = [StructField(f.name, f.dataType) for f in schema.fields]
    read = spark.readStream.schema(StructType([*fields, StructField(_BAD, StringType())]))
    options = {"recursiveFileLookup": "true", "columnNameOfCorruptRecord": _BAD}
    if files_per_run:
        options["maxFilesPerTrigger"] = str(files_per_run)
    lines = read.options(**options).json(f"{base_path.rstrip('/')}/*/{kind}").select(
        "*",
        F.struct(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("changed"),
        ).alias("file"),
    )
    done = []

    def keep(run: DataFrame, number: int) -> None:
        good = F.col(_BAD).isNull() & F.col(key).isNotNull()
        # One read of the files for both: the good lines' table has the bad ones beside it.
        marked = run.withColumn("good", good)
        writer = marked.write.mode("overwrite").option("compression", "zstd").partitionBy("good")
        writer.parquet(f"{target}/{kind}/run={number}")
        done.append(number)

    query = (
        lines.writeStream.foreachBatch(keep)
        .option("checkpointLocation", f"{target}/_manifest/{kind}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(done)


def _runs(spark: SparkSession, target: str, kind: str) -> DataFrame | None:
    """All runs' lines. A run that is not whole has no mark of success and is left out."""
    schema, *_ = _KINDS[kind]
    fields = [StructField(f.name, f.dataType) for f in schema.fields]
    file = StructType.fromDDL("path string, size long, changed timestamp")
    whole = [*fields, StructField(_BAD, StringType()), StructField("file", file)]
    whole += StructType.fromDDL("run long, good boolean").fields
    if not exists(spark, f"{target.rstrip('/')}/{kind}"):
        return spark.createDataFrame([], StructType(whole))
    return spark.read.schema(StructType(whole)).parquet(f"{target.rstrip('/')}/{kind}")


def ingested(spark: SparkSession, target: str, kind: str = "transactions") -> DataFrame:
    """The records read so far, with the columns that the loaders give."""
    schema, _, seconds, shown = _KINDS[kind]
    read = _runs(spark, target, kind).filter("good").select(*schema.names)
    return read.withColumns(
        {"date": day_of_epoch(F.col(seconds)), shown: timestamp_of_epoch(F.col(seconds))}
    )


def ingested_bad_lines(spark: SparkSession, target: str, kind: str = "transactions") -> DataFrame:
    """(file, line) of the lines that are no records; the line is null where only its key is
    missing."""
    bad = _runs(spark, target, kind).filter("not good")
    return bad.select(F.col("file.path").alias("file"), F.col(_BAD).alias("line"), *[_KINDS[kind][1]]).drop(
        _KINDS[kind][1]
    )


def manifest(spark: SparkSession, target: str, kind: str = "transactions") -> DataFrame:
    """(path, size, changed, run, lines): the files that were read, each in one run. A file
    without lines is not listed."""
    return (
        _runs(spark, target, kind)
        .groupBy("file.path", "file.size", "file.changed", "run")
        .agg(F.count(F.lit(1)).alias("lines"))
    )
