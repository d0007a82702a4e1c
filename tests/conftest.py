import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("widerow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    return lambda *texts: spark.createDataFrame([(t,) for t in texts], "value string")


@pytest.fixture
def cells(spark):
    """Cells of the default family from (row, name, value, ts) tuples, or of a
    super family from (row, super, name, value, ts) tuples."""
    from widerow import CELL_SCHEMA

    def make(*rows):
        full = [
            ("Keyspace1", "Standard1", r[0], r[1] if len(r) == 5 else None, *r[-3:])
            for r in rows
        ]
        return spark.createDataFrame(full, CELL_SCHEMA)

    return make
