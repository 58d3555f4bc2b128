"""Counters seen several times: max - min + 1 per item, totals per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.operators.skew import with_group_totals
from skeinwork.session import materialize


def delta_aggregates(count_max: str, count_min: str, carry: list[str], order: list[str]) -> list[Column]:
    """Max, min and the carried columns of the latest row, for batch and stream alike.

    Rows with one order value are ordered by the carried columns.
    """
    return [
        F.max(count_max).alias("max_count"),
        F.min(count_min).alias("min_count"),
        F.max(F.struct(F.struct(*order).alias("order"), F.struct(*carry).alias("carry"))).alias("_latest"),
    ]


def with_retweets(df: DataFrame, carry: list[str]) -> DataFrame:
    """Add `retweets` = max - min + 1, before the carried columns."""
    retweets = F.col("max_count") - F.col("min_count") + F.lit(1)
    return df.select(*(c for c in df.columns if c not in carry), retweets.alias("retweets"), *carry)


def with_delta(df: DataFrame, carry: list[str]) -> DataFrame:
    """Unpack the carried columns and add `retweets` = max - min + 1."""
    out = df.withColumn("retweets", F.col("max_count") - F.col("min_count") + F.lit(1))
    return out.withColumns({c: F.col("_latest.carry")[c] for c in carry}).drop("_latest")


def retweet_delta(
    df: DataFrame,
    id: str,
    count_max: str,
    count_min: str,
    carry: list[str],
    order: list[str],
) -> DataFrame:
    """One row per id: max, min, max - min + 1, and `carry` of the last row by `order`."""
    grouped = df.groupBy(F.col(id).alias("tweet_id"))
    return with_delta(grouped.agg(*delta_aggregates(count_max, count_min, carry, order)), carry)


def retweet_report(delta: DataFrame, code: str = "code", more_than: int = 1) -> DataFrame:
    """Rows counted more than `more_than` times, with the total of their code.

    The total includes the rows that are filtered out. `delta` is written once
    because the totals and the detail both read it.
    """
    detail = materialize(delta, "retweet_delta")
    totals = with_group_totals(detail, [code], "retweets", "total_retweets", spread_by=["tweet_id"])
    return totals.where(F.col("retweets") > more_than)
