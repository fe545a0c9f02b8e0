import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from jobweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[8]",
        extra={
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Evaluate a column function over a list of values."""

    def run(fn, values, ddl="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {ddl}")
        return [r["y"] for r in rows.select("i", fn("x").alias("y")).orderBy("i").collect()]

    return run
