"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def get_session(app: str = "pulseframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect.

    ANSI and AQE are Spark's defaults and are left on. Repeated keys in a JSON
    object keep the last value, as most JSON readers do.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.variant.allowDuplicateKeys": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="pulseframe-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/pulseframe/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write once as Parquet and read back, so later passes are columnar scans of
    files that outlive any executor rather than recomputed lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers once per application, wherever they were started."""
    home = os.path.dirname(os.path.abspath(__file__))
    if spark.sparkContext.applicationId in _shipped or not os.path.isdir(home):
        return
    # the driver serves the file to executors as long as the application lives
    path = os.path.join(tempfile.mkdtemp(prefix="pulseframe-"), "pulseframe_sources.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for at, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(at, name)
                    archive.write(file, os.path.join("pulseframe", os.path.relpath(file, home)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(spark.sparkContext.applicationId)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate results."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a folder that exists; those with a leading _ or . are not data."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [status.getPath().getName() for status in found if status.isDirectory()]
    return sorted(name for name in names if name[0] not in "_.")


def read_partitioned(spark: SparkSession, path: str, schema: StructType, may_be_missing: bool = False) -> DataFrame:
    """A folder of Parquet partitions. A folder that is not there is an error, unless the caller is the one
    who will create it."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as missing:
        if not may_be_missing or missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
