"""A folder of files as one data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_folder(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """All lines of all files below any Hadoop path: (file_path, value).

    Spark lists the folder and spreads the splits over the tasks.
    """
    reader = spark.read
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(path).select(F.col("_metadata.file_path").alias("file_path"), "value")


def list_inputs(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One row per file with its size; file contents are not kept."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length")
