"""What the operators share when they run: code on the executors, and tables between their steps."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

from hitloom.session import shared_folder

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    handle, path = tempfile.mkstemp(prefix="hitloom-", suffix=".zip")
    with os.fdopen(handle, "wb") as file, zipfile.ZipFile(file, "w") as archive:
        for folder, _, names in os.walk(os.path.join(root, "hitloom")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


class Workspace:
    """A new folder below the shared one, for the tables of one operator call.

    ``keep`` writes a frame as Parquet and reads it back: later steps then depend on files that
    every executor sees, not on the shuffles and Python work before.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship_code(spark)
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        path = self.folder(name)
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
