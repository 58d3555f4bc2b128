"""Totals per language with the top item of each language."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.functions.langname import with_language_name


def lang_totals(
    df: DataFrame,
    code: str = "code",
    title: str = "title",
    views: str = "views",
    exclude_self: bool = True,
) -> DataFrame:
    """Sum of views, most viewed title and its views per code.

    Rows whose title equals the code are left out before the aggregation; a row
    without a title is not one of them. A tie is won by the larger title. One shuffle, combined on the map side, so a
    code with any share of the rows sends one row per task. Returned unsorted:
    see `by_total`.
    """
    if exclude_self:
        df = df.where(F.coalesce(F.col(title) != F.col(code), F.lit(True)))
    totals = df.groupBy(F.col(code).alias("code")).agg(
        F.sum(views).alias("total_views"),
        F.max_by(title, F.struct(F.col(views), F.col(title))).alias("top_title"),
        F.max(views).alias("top_views"),
    )
    return with_language_name(totals, "code", "language").select(
        "language", "code", "total_views", "top_title", "top_views"
    )


def by_total(df: DataFrame, total: str = "total_views", *ties: str) -> DataFrame:
    """Descending by one number, with tie-breakers for a repeatable order."""
    return df.orderBy(F.desc(total), *(ties or ("code",)))
