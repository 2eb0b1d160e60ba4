"""The queries of this subpackage, each with its SQL where SQL can state the result."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; the package is shipped to the executors first."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ship_package(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a corpus table; a scan with fewer partitions than cores is dealt out anew."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
