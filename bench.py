"""Times the shared stages and every registered query; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the tables and the cores. Stages (names with
``stage_``) are built in order from the raw tables, each reading the ones before it, and
are part of the total. A query runs to the end of its plan; its rows are thrown away.
"""

import json
import os
import time

from pyspark.sql import SparkSession

from coinstrata.plans.queries import QUERIES, pipeline_for

STAGES = ["records", "blocks", "utxos", "spends", "entities", "entity_balances", "history", "daily"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("coinstrata-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    pipeline = pipeline_for(spark, sf_dir)

    seconds: dict[str, float] = {}
    for name in STAGES:
        started = time.perf_counter()
        getattr(pipeline, name)
        seconds[f"stage_{name}"] = round(time.perf_counter() - started, 3)
    for name, run in QUERIES.items():
        started = time.perf_counter()
        run(pipeline).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)

    pipeline_seconds = sum(s for name, s in seconds.items() if name.startswith("stage_"))
    print(
        json.dumps(
            {
                "metric": "all stages and queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "pipeline_sec": round(pipeline_seconds, 3),
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
