"""Versioned folders and listings through Hadoop, on any path the cluster can read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.exists(hadoop_path)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of a folder; none if it does not exist."""
    fs, hadoop_path = _filesystem(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path)]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote; nothing happens if it is not there."""
    fs, hadoop_path = _filesystem(spark, path)
    fs.delete(hadoop_path, True)


class VersionedTable:
    """A table replaced as a whole: each save is a new folder, the newest complete one counts.

    Spark's success file marks a version complete, so a writer that dies half-way leaves
    the previous version in force. One writer at a time, as a scheduled job is.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.fmt = fmt

    def versions(self) -> list[int]:
        names = folder_names(self.spark, self.path)
        return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))

    def read(self) -> DataFrame:
        for version in reversed(self.versions()):
            folder = f"{self.path}/version={version}"
            if exists(self.spark, f"{folder}/_SUCCESS"):
                return self.spark.read.schema(self.schema).format(self.fmt).load(folder)
        return self.spark.createDataFrame([], self.schema)

    def replace(self, df: DataFrame) -> None:
        version = max(self.versions(), default=-1) + 1
        df.write.format(self.fmt).save(f"{self.path}/version={version}")
