"""What every operator with Python tasks needs: the package on the executors, and bounded batches."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import pulseframe

RECORDS = 1000
BYTES = 8 << 20

_shipped: set[str] = set()


def bound_batches(spark: SparkSession) -> None:
    """Texts reach Python in Arrow batches of a few MB, not of 10,000 texts whatever their length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(RECORDS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES))
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers once per application, wherever they were started."""
    home = os.path.dirname(pulseframe.__file__)
    if spark.sparkContext.applicationId in _shipped or not os.path.isdir(home):
        return
    # the driver serves the file to executors as long as the application lives
    path = os.path.join(tempfile.mkdtemp(prefix="pulseframe-"), "pulseframe_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for at, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(at, name)
                    archive.write(file, os.path.join("pulseframe", os.path.relpath(file, home)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(spark.sparkContext.applicationId)
