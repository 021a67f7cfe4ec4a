import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate expressions over one literal row."""

    def evaluate(row: dict, *columns, schema=None):
        schema = schema or ", ".join(
            f"{k} {'long' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}"
            for k, v in row.items()
        )
        return tuple(spark.createDataFrame([tuple(row.values())], schema).select(*columns).first())

    return evaluate


@pytest.fixture
def plan_of():
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
