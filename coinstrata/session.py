"""Session factory for stand-alone use, and the folder for stage tables."""

import uuid

from pyspark.sql import SparkSession

from coinstrata.sources.files import create_for_session


def create_spark_session(
    app_name: str = "coinstrata",
    driver_memory: str = "8g",
    enable_graphframes: bool = True,
    suppress_logs: bool = True,
    master: str | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session in UTC time; everything else is what the cluster or the caller has set.

    Without ``master`` the one configured for the process is used, else all local cores.
    ``enable_graphframes`` is accepted for callers that pass it; the component operator
    needs no package. Size ``spark.sql.shuffle.partitions`` for the largest shuffle:
    adaptive execution only merges partitions.
    """
    builder = SparkSession.builder.appName(app_name).config(
        map={"spark.driver.memory": driver_memory, "spark.sql.session.timeZone": "UTC"}
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if suppress_logs:
        spark.sparkContext.setLogLevel("ERROR")
    return spark


def stage_folder(spark: SparkSession) -> str:
    """The folder below which stage tables go: the checkpoint folder of the session, in
    its setting or set by ``setCheckpointDir``, else one below the warehouse. All of
    these are shared by the executors."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = configured or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_stages").rstrip("/")


def own_folder(spark: SparkSession, kind: str, parent: str | None = None) -> str:
    """A new folder below ``parent`` (default: the stage folder), which goes when the
    application ends."""
    path = f"{parent or stage_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    create_for_session(spark, path)
    return path
