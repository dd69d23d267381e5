"""Joins on a key that holds a third of all rows must be split, not run in one task."""

import subprocess
import sys
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from coinstrata.operators.clustering import star_edges, tx_address_sets
from coinstrata.operators.components import _rewrite, connected_groups
from coinstrata.operators.history import owned_history
from coinstrata.operators.skew import numbered, ranked, with_neighbours
from coinstrata.operators.spends import link_spends
from coinstrata.session import own_folder, stage_folder

ROWS = 60_000


@contextmanager
def small_cluster(spark):
    """Thresholds scaled down so that a test table counts as large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def splits_of(df):
    """Joins in the plan after execution that were split for skew."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString().count("skew=true")


def third(hot, other):
    return F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(other)


@pytest.fixture
def stored(spark, tmp_path):
    def store(name, df):
        path = str(tmp_path / name)
        df.repartition(12).write.parquet(path)
        return spark.read.parquet(path)

    return store


def test_hot_address(spark, stored):
    address = third("hot", F.col("id").cast("string"))
    outputs = spark.range(ROWS).select(
        F.col("id").cast("string").alias("tx_hash"),
        F.lit(0).alias("output_index"),
        F.col("id").alias("value"),
        F.array(address).alias("addresses"),
        F.col("id").alias("block_timestamp"),
        F.lit(None).cast("long").alias("spent_timestamp"),
    )
    outputs = stored("outputs", outputs)
    entities = stored(
        "entities",
        outputs.select(F.col("addresses")[0].alias("address")).distinct().withColumn(
            "entity_id", F.lit("e")
        ),
    )
    with small_cluster(spark):
        history = owned_history(outputs, outputs.limit(0), entities)
        assert splits_of(history) == 1
        assert history.count() == ROWS


def test_hot_and_missing_references(spark, stored):
    outputs = stored(
        "outputs",
        spark.range(ROWS).select(
            F.col("id").cast("string").alias("tx_hash"),
            F.lit(0).alias("output_index"),
            F.array(F.lit("A")).alias("addresses"),
        ),
    )

    def spending(reference):
        spend = F.struct(
            reference.alias("spent_transaction_hash"),
            F.lit(0).alias("spent_output_index"),
            F.array(F.lit("R")).alias("addresses"),
        )
        return spark.range(ROWS).select(
            F.concat(F.lit("s"), F.col("id")).alias("hash"),
            F.col("id").alias("block_timestamp"),
            F.lit(False).alias("is_coinbase"),
            F.lit(2).alias("input_count"),
            F.array(spend).alias("inputs"),
        )

    hot = stored("hot", spending(third("7", F.col("id").cast("string"))))
    missing = stored("missing", spending(F.when(F.col("id") % 3 > 0, F.col("id").cast("string"))))
    with small_cluster(spark):
        linked = link_spends(hot, outputs)
        assert splits_of(linked) == 1
        assert linked.filter("has_source").count() == ROWS
        linked = link_spends(missing, outputs)
        assert splits_of(linked) == 0
        assert linked.filter("has_source").count() == ROWS * 2 // 3


def test_hub_of_the_graph(spark, stored):
    edges = stored(
        "edges", spark.range(1, ROWS).select(third(0, F.col("id") + ROWS).alias("a"), F.col("id").alias("b"))
    )
    moves = stored(
        "moves",
        edges.select(F.explode(F.array("a", "b")).alias("v")).distinct().withColumn("r", F.col("v")),
    )
    with small_cluster(spark):
        rewritten = _rewrite(edges, moves)
        assert splits_of(rewritten) >= 1
        assert rewritten.count() == ROWS - 1


class _Session:
    """As much of a session as the folder lookup asks for."""

    def __init__(self, checkpoints=None, **conf):
        self.conf = {"spark.sql.warehouse.dir": "s3://lake/warehouse", **conf}
        self.sparkContext = type("Context", (), {"getCheckpointDir": lambda _: checkpoints})()


def test_stage_folder():
    shared = {"spark.checkpoint.dir": "hdfs:///shared/"}
    assert stage_folder(_Session(**shared)) == "hdfs:///shared"
    assert stage_folder(_Session("hdfs:///set")) == "hdfs:///set"
    assert stage_folder(_Session()) == "s3://lake/warehouse/_stages"


def test_own_folders_are_new(spark, tmp_path):
    one, two = (own_folder(spark, "kind", str(tmp_path)) for _ in range(2))
    assert one != two and sorted(map(str, tmp_path.iterdir())) == sorted([one, two])


def test_hot_transaction_of_clustering(spark, stored, tmp_path):
    """A transaction with a third of all inputs, for stars and for components."""
    members = stored(
        "members",
        spark.range(ROWS).select(
            third("hot", F.col("id").cast("string")).alias("tx_hash"),
            F.concat(F.lit("a"), F.col("id")).alias("address"),
        ),
    )
    with small_cluster(spark):
        stars = star_edges(members, str(tmp_path))
        assert splits_of(stars) >= 1
        assert stars.count() == ROWS // 3 - 1
        sets = tx_address_sets(members, str(tmp_path))
        assert splits_of(sets) >= 1
        assert sets.count() == ROWS // 3
        grouped = members.select(F.col("tx_hash").alias("group"), F.col("address").alias("id"))
        found = connected_groups(grouped, str(tmp_path))
        assert found.count() == ROWS // 3 and found.select("component").distinct().count() == 1


def test_hot_group_is_numbered_over_several_tasks(spark, tmp_path):
    """Two thirds of the rows in one group, all of the same day: positions and neighbours."""
    rows = spark.range(ROWS).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("key"),
        F.lit("1995-01-01").alias("day"),
        F.hash("id").alias("order"),
        "id",
    )
    with small_cluster(spark):
        done = numbered(rows, "key", ["day", "order", "id"], str(tmp_path), "place").cache()
        hot = done.filter("key = 7")
        assert hot.select("place").distinct().count() == hot.count() == ROWS * 2 // 3
        in_order = [r.id for r in hot.orderBy("place").collect()]
        assert in_order == [r.id for r in hot.orderBy("order", "id").collect()]
        assert done.filter("key <> 7 and place <> 0").count() == 0
        done.unpersist()
        linked = with_neighbours(rows, "key", ["day", "order", "id"], ["id"], str(tmp_path))
        following = {r.id: r.f for r in linked.filter("key = 7").select("id", F.col("following.id").alias("f")).collect()}
        assert [following[i] for i in in_order] == [*in_order[1:], None]
        previous = linked.filter("key = 7 and previous is null").count()
        assert previous == 1 and linked.count() == ROWS
        dealt = [p for p in tmp_path.iterdir() if p.name.startswith("ranges-")]
        for folder in dealt:
            parts = spark.read.parquet(str(folder)).filter("key = 7").groupBy("_part").count()
            assert parts.count() >= 8 and parts.agg({"count": "max"}).first()[0] < ROWS / 8
        place = ranked(rows, ["order", "id"], str(tmp_path), "place")
        assert [r.id for r in place.orderBy("place").select("id").collect()] == [
            r.id for r in rows.orderBy("order", "id").collect()
        ]
        assert place.agg(F.min("place"), F.max("place")).first()[:] == (0, ROWS - 1)


def test_session_factory():
    code = (
        "from coinstrata import create_spark_session as c\n"
        "s = c(driver_memory='1g', enable_graphframes=True, extra_conf={'spark.ui.enabled': 'false'})\n"
        "assert s.conf.get('spark.sql.adaptive.skewJoin.enabled') == 'true'\n"
        "assert s.conf.get('spark.sql.session.timeZone') == 'UTC'\n"
        "print(s.range(3).count())"
    )
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300
    )
    assert done.stdout.split()[-1] == "3"
