"""Contiguous shards of near equal bytes.

Rows are ordered by id in range partitions. The bytes before a row are a
running sum inside its partition plus the totals of the partitions before it:
one row per partition takes part in the global prefix sum. The byte axis is cut
at equal targets, and a row goes where its middle lies, so a shard misses its
target by at most half a row at either end.

Defined results: a null text has no bytes. Rows with a null id come first; rows
with equal ids are ordered by checksum and size. A row larger than a target
leaves shards empty. An empty table gives an empty result. Extra columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinwork.session import materialize

ROWS_PER_PARTITION = 1_000_000      # ordered rows of id, size and checksum in one task
ROW_OVERHEAD = 8                    # bytes that a row takes besides its text


def shard_by_bytes(
    docs: DataFrame, shards: int, id: str = "doc_id", text: str = "text",
    overhead: int = ROW_OVERHEAD, rows_per_partition: int = ROWS_PER_PARTITION,
) -> DataFrame:
    """Per row: id, `size`, `text_crc32`, `law`, `shard`, `slot` (0, 1, ... in the shard), `grown_shard` (null)."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = materialize(
        docs.select(
            F.col(id).alias("id"),
            (F.octet_length(body) + overhead).cast("bigint").alias("size"),
            F.crc32(body.cast("binary")).alias("crc"),
        ),
        "sizes",
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + rows.count() // rows_per_partition)
    order = ["id", "crc", "size"]
    ordered = materialize(
        rows.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.spark_partition_id()),
        "ordered",
    )
    # one row per partition
    everything = Window.partitionBy(F.lit(0)).orderBy("part")
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    totals = ordered.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    offsets = totals.select(
        "part", "first",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy(F.lit(0))).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("bytes_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    cut = (
        ordered.join(F.broadcast(offsets), "part")
        .withColumn("start", start)
        .withColumn("position", F.col("rows_before") + F.col("at") - F.col("first"))
        .withColumn("shard", F.expr(f"least({shards - 1}, (2 * start + size) * {shards} div (2 * all_bytes))").cast("int"))
    )
    # one row per shard
    firsts = cut.groupBy("shard").agg(F.min("position").alias("shard_first"))
    return cut.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("position") - F.col("shard_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
