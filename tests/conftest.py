import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from holdshort.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Build a table from rows; columns of type ts are given in seconds since the epoch."""
    from pyspark.sql import functions as F

    def make(rows, schema):
        fields = [part.split() for part in schema.split(",")]
        df = spark.createDataFrame(rows, ", ".join(f"{n} {'double' if k == 'ts' else k}" for n, k in fields))
        for name, kind in fields:
            if kind == "ts":
                df = df.withColumn(name, F.timestamp_micros((F.col(name) * 1_000_000).cast("long")))
        return df
    return make


def seconds(row, name):
    value = row[name]
    return None if value is None else value.timestamp()
