import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a one-column expression over values, in order."""
    from pyspark.sql import functions as F

    def evaluate(values, expression, kind="string"):
        rows = [(i, value) for i, value in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        out = df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
        return [row.out for row in out]

    return evaluate
