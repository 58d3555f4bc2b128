"""Duplicate marking: the best row of a key stays, the others get a flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.functions.text import percent


def mark_duplicates(df: DataFrame, keys: list, score: str, id: str) -> DataFrame:
    """Add `is_duplicate`: false for the row with the highest score, then the smallest id, of its key.

    A row without a score loses to every row with one.
    `id` must be unique. The winners are found by a map-side-combined minimum,
    and are joined back by id: a key with any number of copies stays balanced,
    where a window over the key would sort all copies in one task.
    """
    best = F.min(F.struct(F.col(score).isNull().alias("_none"), (-F.col(score)).alias("_s"), F.col(id).alias("_id")))
    winners = df.groupBy(*keys).agg(best.alias("_best")).select(F.col("_best._id").alias(id), F.lit(True).alias("_kept"))
    return df.join(winners, id, "left").withColumn("is_duplicate", F.col("_kept").isNull()).drop("_kept")


def duplicate_metrics(marked: DataFrame) -> DataFrame:
    """Rows, duplicates and their share, one row."""
    return marked.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_duplicate").alias("duplicates"),
        F.round(percent(F.count_if("is_duplicate"), F.count(F.lit(1))), 6).alias("pct_duplicates"),
    )
