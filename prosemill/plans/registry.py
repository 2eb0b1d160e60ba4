"""Named queries over the corpus tables, each with the SQL that states its result."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.session import ship_package
from ..sources.storage import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` no SQL engine can state the result."""

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
    """A corpus table restricted to the columns in use, on all cores, shuffles sized for it."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df.select(*columns) if columns else df)


def documents(spark, sf_dir, *columns) -> DataFrame:
    return table(spark, sf_dir, "documents", *(columns or ("doc_id", "text")))


def text_query(name: str, expression, sql: str | None, output: str = "result", source: str = "documents"):
    """A query that maps one text column per row: id and result."""
    ids, column = {"documents": ("doc_id", "text"), "pages": ("page_id", "html")}[source]

    @query(name, sql and f"SELECT {ids}, {sql} AS {output} FROM {source}")
    def run(spark, sf_dir):
        return table(spark, sf_dir, source, ids, column).select(
            ids, expression(F.col(column)).alias(output))
