import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from prosemill.sources.session import ship_package

    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield ship_package(session)
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """apply(column function, values) -> results in order."""
    from pyspark.sql import functions as F

    def run(fn, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i bigint, v {kind}")
        out = df.select("i", fn(F.col("v")).alias("r")).collect()
        return [r.r for r in sorted(out, key=lambda r: r.i)]

    return run


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
