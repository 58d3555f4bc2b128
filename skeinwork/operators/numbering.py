"""Row numbers over a whole data set without a one-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinwork.session import materialize, materialize_counted

ROWS_PER_PARTITION = 2_000_000      # of the range partitions when the caller names no number
_PART_BITS = 33     # monotonically_increasing_id: partition number above, row number below


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def global_index(
    df: DataFrame,
    order: list[str | Column],
    name: str = "idx",
    total: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """0-based position of every row in the order given by `order`.

    One range shuffle and a sort inside each partition; the position inside a
    partition is free, the offset of a partition is a prefix sum over one row
    per partition. The numbered rows are written once, so a lost executor
    cannot change a number. End `order` with a unique column: that makes the
    result repeatable and lets the range partitioner split any hot value.
    With `total`, the row count is added under that name.

    `df` itself runs once, also when it is costly to compute: its rows are
    counted while they are written, and the range partitioner samples and reads
    the written table.
    """
    spark = df.sparkSession
    df, rows = materialize_counted(df, "unnumbered")
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + rows // ROWS_PER_PARTITION)
    cols = [_column(c) for c in order]
    numbered = materialize(
        df.repartitionByRange(n, *cols)
        .sortWithinPartitions(*cols)
        .withColumn("_mid", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_part", F.shiftright("_mid", _PART_BITS))
    # one row per partition: bounded by the number of partitions
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    offsets = (
        numbered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_part",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
            F.sum("_n").over(everything).alias("_total"),
        )
    )
    row = F.col("_mid") - F.shiftleft("_part", _PART_BITS)
    out = numbered.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_offset") + row)
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_mid", "_part", "_offset", "_total")


def line_offsets(lines: DataFrame) -> DataFrame:
    """Per file and split of a `spark.read.text` frame: the lines in it (`_n`) and before it (`_offset`), and its first `_mid`.

    Expects the columns that `number_lines` names. One row per split takes part
    in the prefix sum; the result is written.
    """
    blocks = lines.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(blocks.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))), "line_offsets")


def number_lines(lines: DataFrame, name: str = "line_no", offsets: DataFrame | None = None) -> DataFrame:
    """0-based line number in a `spark.read.text` frame with file and block columns.

    Expects `file`, `block` (start of the file split) and `_mid`
    (monotonically_increasing_id taken at the scan). The rows of `line_offsets`
    are joined by split; Spark broadcasts them while their bytes are below its
    threshold, and the text is not shuffled then.
    """
    offsets = line_offsets(lines) if offsets is None else offsets
    return (
        lines.join(offsets.drop("_n"), ["file", "block"])
        .withColumn(name, F.col("_offset") + F.col("_mid") - F.col("_first"))
        .drop("_offset", "_first", "_mid", "block")
    )
