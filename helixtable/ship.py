"""The package on the executors' path."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors of this application, once, for clusters on which it is not installed.

    Call it before operators that run Python in tasks where the package is on the driver's path alone.
    """
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parent
        spark.sparkContext.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='spark-')}/{root.name}", "zip", root.parent, root.name))
        _SHIPPED.add(app)
