"""Make this package importable in the Python workers of a session."""

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Send the package to all executors, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(app)
    return spark
