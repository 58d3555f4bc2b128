"""SAM text: eleven tab-separated columns and tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.functions.reads import alignment_end, decode_quality, is_main_mapped

# The columns of the format in order.
SAM_COLUMNS = [
    ("qname", "string"), ("flag", "int"), ("rname", "string"), ("pos", "bigint"), ("mapq", "int"),
    ("cigar", "string"), ("rnext", "string"), ("pnext", "bigint"), ("tlen", "bigint"),
    ("seq", "string"), ("qual", "string"),
]
BROADCAST_BYTES = 64 << 20  # a dictionary up to this size is broadcast


def parse_sam(lines: DataFrame) -> DataFrame:
    """Alignment lines to typed columns; header lines are dropped, bad numbers become NULL.

    Adds `quals` (numbers) and `end_pos` (1-based inclusive).
    """
    parts = lines.where(~F.col("value").startswith("@")).select(F.split("value", "\t").alias("_parts"))
    columns = [F.get("_parts", F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(SAM_COLUMNS)]
    tags = F.slice("_parts", 12, F.greatest(F.size("_parts") - 11, F.lit(0))).alias("tags")
    return (
        parts.select(*columns, tags)
        .withColumn("quals", decode_quality(F.col("qual")))
        .withColumn("end_pos", alignment_end(F.col("pos"), F.col("cigar")))
    )


def with_reference_index(reads: DataFrame, dictionary: DataFrame, name: str = "rname", out: str = "ref_index") -> DataFrame:
    """Add the index of the reference; -1 when it is not in the dictionary.

    A dictionary is the header of a file: it is broadcast after a check of its
    bytes. Beyond the bound Spark joins by name and splits the large names.
    """
    size = dictionary.agg(F.sum(F.octet_length("name") + 16)).first()[0] or 0
    small = size <= BROADCAST_BYTES
    dim = dictionary.select(F.col("name").alias("_name"), F.col("ref_index").alias("_index"))
    joined = reads.join(F.broadcast(dim) if small else dim, F.col(name) == F.col("_name"), "left")
    return joined.withColumn(out, F.coalesce("_index", F.lit(-1))).drop("_name", "_index")


def read_sam(spark: SparkSession, path: str, dictionary: DataFrame | None = None, main_only: bool = False) -> DataFrame:
    """Reads of a file or folder; with a dictionary also `ref_index`.

    main_only=True keeps mapped reads on chr1..chr22, chrX and chrY.
    """
    reads = parse_sam(spark.read.text(path))
    if dictionary is None:
        return reads
    reads = with_reference_index(reads, dictionary)
    return reads.where(is_main_mapped(F.col("flag"), F.col("ref_index"))) if main_only else reads
