import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def one(spark):
    """one(expression, value): the value of a Column expression over a single text `c`."""
    from pyspark.sql import functions as F

    def run(make, *values):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, c STRING")
        out = [r.out for r in rows.select("i", make(F.col("c")).alias("out")).orderBy("i").collect()]
        return out if len(out) > 1 else out[0]

    return run
