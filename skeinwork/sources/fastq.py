"""FASTQ text: four lines per read, one or several files per mate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.operators.numbering import line_offsets, number_lines

LINES_PER_READ = 4      # fixed value of the format


def read_fastq_counted(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(file, rec, line_no, line), and the number of lines per file as (file, lines).

    Records are numbered per file, from 0. `file` is the whole path. The files
    are read for the lines per split, from which both results come, and for the lines.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    offsets = line_offsets(lines)
    numbered = number_lines(lines, "_line", offsets).select(
        "file",
        F.floor(F.col("_line") / LINES_PER_READ).cast("bigint").alias("rec"),
        (F.col("_line") % LINES_PER_READ).cast("int").alias("line_no"),
        "line",
    )
    return numbered, offsets.groupBy("file").agg(F.sum("_n").alias("lines"))


def read_fastq_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, rec, line_no, line): records are numbered per file, from 0. `file` is the whole path."""
    return read_fastq_counted(spark, path)[0]


def read_fastq(spark: SparkSession, path: str, mate: int = 1) -> DataFrame:
    """One row per read: (file, rec, mate, lines)."""
    item = F.struct("line_no", "line")
    ordered = F.sort_array(F.collect_list(item))        # four lines
    return (
        read_fastq_lines(spark, path)
        .groupBy("file", "rec")
        .agg(F.transform(ordered, lambda x: x["line"]).alias("lines"))
        .withColumn("mate", F.lit(mate))
    )
