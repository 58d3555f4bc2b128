"""VCF text: variant lines and their comparison keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.functions.coords import chrom_number

# The column line of the written table, without the name of the sample.
VCF_HEADER = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT"


def parse_vcf(lines: DataFrame, on_error: str = "null") -> DataFrame:
    """Lines that start with `chr` to (chrom, chrom_no, pos, id, ref, alt, line).

    A name without a number (chrM) gives a NULL chrom_no, or an error, or is
    dropped, by `on_error`.
    """
    # a line to drop is known from its first two fields, which one expression splits off and tests: a filter on
    # columns of their own would make the line anew, and split it, once per use
    kept = F.col("value").startswith("chr")
    if on_error == "drop":
        numbered = lambda p: chrom_number(F.get(p, F.lit(0))).isNotNull() & F.get(p, F.lit(1)).try_cast("bigint").isNotNull()
        kept = kept & F.exists(F.array(F.split("value", "\t", 3)), numbered)
    parts = lines.where(kept).select("value", F.split("value", "\t", 6).alias("_parts"))
    field = lambda i: F.get("_parts", F.lit(i))
    rows = parts.select(
        field(0).alias("chrom"), field(1).alias("_pos"), field(2).alias("id"),
        field(3).alias("ref"), field(4).alias("alt"), F.col("value").alias("line"),
    ).withColumn("_number", chrom_number(F.col("chrom")))
    number, pos = F.col("_number"), F.col("_pos").try_cast("bigint")
    if on_error == "fail":
        unknown = F.raise_error(F.concat(F.lit("no chromosome number: "), "chrom")).cast("int")
        number, pos = F.when(number.isNull(), unknown).otherwise(number), F.col("_pos").cast("bigint")
    return rows.select("chrom", number.alias("chrom_no"), pos.alias("pos"), "id", "ref", "alt", "line")


def read_vcf(spark: SparkSession, path: str, on_error: str = "null") -> DataFrame:
    return parse_vcf(spark.read.text(path), on_error)


def parse_vcf_keys(lines: DataFrame) -> DataFrame:
    """Comparison keys: blank-separated fields 0, 1, 3, 4 of lines whose first field contains `chr`."""
    parts = lines.select(F.split(F.trim("value"), r"\s+").alias("_parts"))
    field = lambda i: F.get("_parts", F.lit(i))
    rows = parts.select(field(0).alias("chrom"), field(1).alias("pos"), field(3).alias("ref"), field(4).alias("alt"))
    return rows.where(F.col("chrom").contains("chr"))


def read_vcf_keys(spark: SparkSession, path: str) -> DataFrame:
    return parse_vcf_keys(spark.read.text(path))
