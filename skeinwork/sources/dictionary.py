"""Sequence dictionaries: name, length and index of each reference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skeinwork.functions.text import after_first


def parse_dict(lines: DataFrame, position: str = "position") -> DataFrame:
    """`@SQ SN:name LN:length` lines to (ref_index, name, length).

    The index is the rank by `position`; a length that is no number becomes 0.
    A dictionary has one line per reference sequence, so the rank is local.
    """
    fields = F.split("value", r"\s+")
    order = Window.partitionBy(F.lit(0)).orderBy(position)
    return lines.where(F.col("value").startswith("@SQ")).select(
        (F.row_number().over(order) - 1).alias("ref_index"),
        after_first(F.get(fields, F.lit(1)), ":").alias("name"),
        F.coalesce(after_first(F.get(fields, F.lit(2)), ":").try_cast("int").cast("bigint"), F.lit(0).cast("bigint")).alias("length"),
    )


def read_dict(spark: SparkSession, path: str) -> DataFrame:
    """Dictionary file of one split; the index follows the line order."""
    lines = spark.read.text(path).withColumn("position", F.monotonically_increasing_id())
    return parse_dict(lines)
