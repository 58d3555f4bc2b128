"""Variant tables: order, duplicates at region borders, concordance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VARIANT_KEY = ["chrom", "pos", "ref", "alt"]


def sorted_variants(variants: DataFrame, dedup: bool = False) -> DataFrame:
    """By chromosome number and position, over all regions.

    Equal positions are ordered by the line, so the order is repeatable.
    """
    if dedup:
        variants = variants.distinct()
    return variants.orderBy("chrom_no", "pos", "line")


def vcf_concordance(ref: DataFrame, other: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """total = distinct keys of `ref`, matches = those also in `other`, diff = the rest."""
    keys = keys or VARIANT_KEY
    found = other.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return (
        ref.select(*keys)
        .distinct()
        .join(found, keys, "left")
        .agg(F.count(F.lit(1)).alias("total"), F.count("_hit").alias("matches"))
        .withColumn("diff", F.col("total") - F.col("matches"))
    )
