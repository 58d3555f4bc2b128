"""Interleave two mates, each one file or a folder of files, and write them in gzip chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skeinwork.operators.records import interleave
from skeinwork.operators.regions import region_of
from skeinwork.session import materialize
from skeinwork.sources.fastq import LINES_PER_READ, read_fastq_counted
from skeinwork.sources.sinks import write_chunks


BLOCK_RECORDS = 1_000       # records of either mate in a block of text; bounds the list of its lines


def _ranked(files: DataFrame) -> DataFrame:
    """`pair`, the rank of a file's path among the files of its mate, from 0; one row per file."""
    return materialize(files.withColumn("pair", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("file")) - 1), "mate_files")


def check_mates(files1: DataFrame, files2: DataFrame) -> None:
    """Fail unless every pair of files has as many lines in either mate, and whole records. Inputs: (pair, lines)."""
    both = files1.select("pair", F.col("lines").alias("n0")).join(files2.select("pair", F.col("lines").alias("n1")), "pair", "full")
    bad = both.where(~F.col("n0").eqNullSafe(F.col("n1")) | (F.col("n0") % LINES_PER_READ != 0)).orderBy("pair").first()
    if bad is not None:
        raise ValueError(f"file pair {bad['pair']} has {bad['n0']} and {bad['n1']} lines")


def paired_lines(spark: SparkSession, mate1: str, mate2: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lines of either mate as (pair, rec, line_no, line), and (pair, before, total): the records of the pairs before, and of all."""
    lines, files = zip(*(read_fastq_counted(spark, path) for path in (mate1, mate2)))
    files = [_ranked(f) for f in files]
    check_mates(*files)
    # one row per file
    everything = Window.partitionBy(F.lit(0))
    before = everything.orderBy("pair").rowsBetween(Window.unboundedPreceding, -1)
    records = F.col("lines") / LINES_PER_READ
    starts = materialize(files[0].select(
        "pair", F.coalesce(F.sum(records).over(before), F.lit(0)).cast("bigint").alias("before"), F.sum(records).over(everything).cast("bigint").alias("total")
    ), "pair_starts")
    one, two = (m.join(f.select("file", "pair"), "file").drop("file") for m, f in zip(lines, files))
    return one, two, starts


def interleaved(spark: SparkSession, mate1: str, mate2: str) -> DataFrame:
    """(pair, rec, record): files of the two mates pair up by the order of their paths, reads by their position in the file."""
    one, two, _ = paired_lines(spark, mate1, mate2)
    return interleave(one, two, "pair", "rec")


def run(spark: SparkSession, mate1: str, mate2: str, out: str, chunks: int) -> None:
    """`chunks` files `Chunks_<n>.fq.gz` with as many records each, one more in the first ones.

    The number of a record and of all records are known from the line counts, so
    its chunk is arithmetic, and so is its block of `BLOCK_RECORDS` records in the
    chunk. The lines of both mates meet in their block, in as many tasks as Spark
    has; a chunk's task sorts blocks of text, a row each, and not lines.
    """
    one, two, starts = paired_lines(spark, mate1, mate2)
    lines = one.withColumn("mate", F.lit(1)).unionByName(two.withColumn("mate", F.lit(2))).join(starts, "pair")
    index = F.col("before") + F.col("rec")
    dealt = lines.select(region_of(index, F.col("total"), chunks).alias("chunk"), index.alias("idx"), "mate", "line_no", "line")
    in_order = F.sort_array(F.collect_list(F.struct("idx", "mate", "line_no", "line")))
    blocks = dealt.groupBy("chunk", F.floor(F.col("idx") / BLOCK_RECORDS).alias("block")).agg(
        F.array_join(F.transform(in_order, lambda x: x["line"]), "\n").alias("lines")
    )
    write_chunks(blocks, out, chunks, ["block"], "lines", chunk="chunk")
