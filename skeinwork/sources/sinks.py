"""Writers. All of them write partitions in parallel through the Spark writers."""

from __future__ import annotations

import gzip

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.functions.coords import bed_end, bed_start, region_string
from skeinwork.session import name_parts
from skeinwork.sources.text_records import RETWEET_LOG_HEADER, retweet_log_lines
from skeinwork.sources.vcf import VCF_HEADER


def write_report(df: DataFrame, path: str, format: str = "csv", single_file: bool = False, mode: str = "errorifexists") -> None:
    """Report table with a header; part files keep the order of a sorted frame.

    single_file=True sends the report through one task: for small reports only.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode(mode)
    if format == "csv":
        writer = writer.option("header", True)
    writer.format(format).save(path)


def tuple_lines(df: DataFrame) -> DataFrame:
    """Rows as `(a,b,c)` text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns]
    return df.select(F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")")).alias("value"))


def write_retweet_log(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Report rows of the stream as log text: `<path>/header`, and part files below `<path>/lines`."""
    header = rows.sparkSession.range(1).select(F.lit(RETWEET_LOG_HEADER).alias("value"))
    header.write.mode(mode).text(f"{path}/header")
    retweet_log_lines(rows).write.mode(mode).text(f"{path}/lines")


CHUNK_NAME = "Chunks_{}.fq.gz"     # fixed value: name of a chunk's file


def write_chunks(
    records: DataFrame, path: str, n: int, order: list[str] | None = None, record: str = "record", mode: str = "errorifexists",
    chunk: str | None = None,
) -> None:
    """n gzip text chunks holding contiguous ranges of the record number (`rec`, or the columns of `order`), in order.

    With `chunk`, a column of whole numbers from 0 to n - 1, a row goes to that
    chunk and the files are named `Chunks_<n>.fq.gz`; a chunk without rows is an empty file.
    Without it, ranges come from a sample and the files keep the writer's names.
    """
    order = order or ["rec"]
    if chunk is None:
        dealt = records.repartitionByRange(n, *order).sortWithinPartitions(*order).select(record)
    else:
        dealt = records.repartitionById(n, F.col(chunk).cast("int")).sortWithinPartitions(*order).select(record)
    dealt.write.mode(mode).option("compression", "gzip").text(path)
    if chunk is not None:
        name_parts(records.sparkSession, path, n, CHUNK_NAME, gzip.compress(b""))


def write_vcf(variants: DataFrame, path: str, sample: str = "ls", mode: str = "errorifexists") -> None:
    """The column line, then variant lines by chromosome and position.

    The part files follow the global order and the first one begins with the
    column line, so the files one after another are a VCF table.
    """
    spark = variants.sparkSession
    header = spark.range(1).select(
        F.lit(-1).alias("chrom_no"), F.lit(-1).cast("bigint").alias("pos"), F.lit(f"{VCF_HEADER}\t{sample}").alias("line")
    )
    rows = variants.select("chrom_no", "pos", "line").withColumn("chrom_no", F.coalesce("chrom_no", F.lit(0)))
    header.unionByName(rows).orderBy("chrom_no", "pos", "line").select("line").write.mode(mode).text(path)


def bed_lines(intervals: DataFrame, half_open: bool = True) -> DataFrame:
    """1-based inclusive intervals as `chrom TAB start TAB end` text."""
    return intervals.select(
        F.concat_ws(
            "\t", "chrom", bed_start(F.col("start")).cast("string"), bed_end(F.col("end"), half_open).cast("string")
        ).alias("value")
    )


def write_bed(intervals: DataFrame, path: str, half_open: bool = True, mode: str = "errorifexists") -> None:
    bed_lines(intervals.orderBy("chrom", "start"), half_open).write.mode(mode).text(path)


def write_regions(intervals: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """`name:start-end` lines."""
    line = region_string(F.col("chrom"), F.col("start"), F.col("end")).alias("value")
    intervals.orderBy("chrom", "start").select(line).write.mode(mode).text(path)


def write_numbered(people: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """`1. name` lists, one folder per group, in number order."""
    (
        people.orderBy("group", "number")
        .select("group", F.concat(F.col("number").cast("string"), F.lit(". "), "person").alias("value"))
        .write.mode(mode)
        .partitionBy("group")
        .text(path)
    )
