import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from coinstrata.schemas import TRANSACTION_SCHEMA  # noqa: E402
from ledger_data import completed  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("coinstrata-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "America/New_York")  # results must not depend on it
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def workdir(tmp_path):
    return str(tmp_path / "stages")


@pytest.fixture
def ledger(spark):
    """Transactions given as dictionaries, as a DataFrame with the export's schema."""

    def build(*transactions):
        rows = [
            {
                **dict.fromkeys(TRANSACTION_SCHEMA.names),
                **tx,
                "inputs": completed(tx["inputs"], "inputs"),
                "outputs": completed(tx["outputs"], "outputs"),
            }
            for tx in transactions
        ]
        return spark.createDataFrame(rows, TRANSACTION_SCHEMA)

    return build
