"""Tables that become visible together.

A folder has commits ``_commits/000000000007.json``, numbered without gaps; the last one
says which files hold the tables. A commit is written aside and renamed to its number, which
fails if another writer was first, so readers see a commit whole or not at all, and none is
ever changed. Files are written under names of their own before the commit that shows them,
so a failure in between leaves the tables as they were.
"""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from coinstrata.sources.files import (
    delete,
    exists,
    rename_new,
    text_of,
    visible_files,
    write_text,
)
from coinstrata.sources.tables import write_table

_COMMITS = "_commits"


def commit(spark: SparkSession, folder: str, version: int, state: dict) -> None:
    """Make ``state`` commit number ``version``. Fails if that number is taken."""
    folder = folder.rstrip("/")
    aside = f"{folder}/{_COMMITS}/.{uuid.uuid4().hex}"
    write_text(spark, aside, json.dumps(state))
    try:
        rename_new(spark, aside, f"{folder}/{_COMMITS}/{version:012d}.json")
    finally:
        delete(spark, aside)


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of all commits, in order."""
    path = f"{folder.rstrip('/')}/{_COMMITS}"
    if not exists(spark, path):
        return []
    names = [name.rsplit("/", 1)[-1] for name in visible_files(spark, path)]
    return sorted(int(name.removesuffix(".json")) for name in names)


def state_of(spark: SparkSession, folder: str, version: int) -> dict:
    return json.loads(text_of(spark, f"{folder.rstrip('/')}/{_COMMITS}/{version:012d}.json"))


def latest(spark: SparkSession, folder: str) -> tuple[int, dict | None]:
    """Number and state of the last commit; -1 and None without any."""
    found = versions(spark, folder)
    return (found[-1], state_of(spark, folder, found[-1])) if found else (-1, None)


def save_snapshot(base_path: str, **tables: DataFrame) -> int:
    """Write ``tables`` as one new snapshot and return its number. Earlier snapshots stay as
    they are, also for readers that are in the middle of one."""
    spark = next(iter(tables.values())).sparkSession
    base = base_path.rstrip("/")
    version, _ = latest(spark, base)
    folder = f"data/{uuid.uuid4().hex}"
    for name, table in tables.items():
        write_table(table, f"{base}/{folder}/{name}.parquet")
    commit(spark, base, version + 1, {"folder": folder, "tables": sorted(tables)})
    return version + 1


def load_snapshot(
    spark: SparkSession, base_path: str, name: str, version: int | None = None
) -> DataFrame:
    """The table ``name`` of a snapshot, of the last one unless a number is given."""
    base = base_path.rstrip("/")
    if version is None:
        version, state = latest(spark, base)
    else:
        state = state_of(spark, base, version)
    if state is None:
        raise ValueError(f"no snapshot in {base_path}")
    if name not in state["tables"]:
        raise ValueError(f"snapshot {version} has no table {name}")
    return spark.read.parquet(f"{base}/{state['folder']}/{name}.parquet")


def drop_old_snapshots(spark: SparkSession, base_path: str, keep: int = 2) -> list[int]:
    """Delete the files of all but the last ``keep`` snapshots, and their numbers' commits.
    Not for folders that somebody may still be reading an old snapshot of."""
    base = base_path.rstrip("/")
    gone = versions(spark, base)[: -keep or None]
    for version in gone:
        delete(spark, f"{base}/{state_of(spark, base, version)['folder']}")
        delete(spark, f"{base}/{_COMMITS}/{version:012d}.json")
    return gone
