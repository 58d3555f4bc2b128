"""BED text: tab-separated intervals, 0-based and half-open."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER = r"^(track|browser|#)"


def parse_bed(lines: DataFrame) -> DataFrame:
    """(chrom, start, end, rest): header and empty lines are left out."""
    parts = F.split("value", "\t", 4)
    return lines.where(~F.col("value").rlike(HEADER) & (F.trim("value") != "")).select(
        F.get(parts, F.lit(0)).alias("chrom"),
        F.get(parts, F.lit(1)).cast("bigint").alias("start"),
        F.get(parts, F.lit(2)).cast("bigint").alias("end"),
        F.get(parts, F.lit(3)).alias("rest"),
    )


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return parse_bed(spark.read.text(path))


def read_bed_header(spark: SparkSession, path: str) -> DataFrame:
    """The header lines, to be put in front of a derived table."""
    return spark.read.text(path).where(F.col("value").rlike(HEADER))
