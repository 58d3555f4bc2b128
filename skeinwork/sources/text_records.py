"""Line and paragraph records: page counts, retweet logs, membership lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.functions.text import before_first, head_and_rest, one_line
from skeinwork.functions.titles import is_series, title_key, title_year

# Header line and field positions of the retweet log.
RETWEET_LOG_HEADER = (
    "Seconds,Language,Language-code,TotalRetweetsInThatLang,IDOfTweet,"
    "MaxRetweetCount,MinRetweetCount,RetweetCount,Text"
)
RETWEET_LOG_FIELDS = 9


def typed(value: Column, kind: str, on_error: str) -> Column:
    """Cast under an error policy: `fail` raises, `null` and `drop` give NULL."""
    return value.cast(kind) if on_error == "fail" else value.try_cast(kind)


def _drop_bad(df: DataFrame, columns: list[str], on_error: str) -> DataFrame:
    return df.dropna(subset=columns) if on_error == "drop" else df


def _required(value: Column, what: str, on_error: str) -> Column:
    if on_error != "fail":
        return value
    return F.when(value.isNull(), F.raise_error(F.lit(f"missing field: {what}"))).otherwise(value)


def parse_pagecounts(lines: DataFrame, on_error: str = "fail") -> DataFrame:
    """Space-separated `project title views bytes` lines to (code, title, views).

    The code is the project name before its first dot.
    """
    parts = lines.select(F.split("value", " ").alias("_parts"))
    field = lambda i: F.get("_parts", F.lit(i))
    out = parts.select(
        before_first(field(0), ".").alias("code"),
        _required(field(1), "title", on_error).alias("title"),
        _required(typed(field(2), "bigint", on_error), "views", on_error).alias("views"),
    )
    return _drop_bad(out, ["title", "views"], on_error)


def read_pagecounts(spark: SparkSession, path: str, on_error: str = "fail") -> DataFrame:
    return parse_pagecounts(spark.read.text(path), on_error)


def parse_retweet_log(
    lines: DataFrame, on_error: str = "fail", truncate_text: bool = False, header: str = RETWEET_LOG_HEADER
) -> DataFrame:
    """Comma-separated log lines to typed columns; every line equal to the header is dropped.

    The text is the rest of the line and may hold commas; truncate_text=True
    cuts it at its first comma.
    """
    parts = lines.where(F.col("value") != header).select(F.split("value", ",", RETWEET_LOG_FIELDS).alias("_parts"))
    field = lambda i: F.get("_parts", F.lit(i))
    number = lambda i, what: _required(typed(field(i), "bigint", on_error), what, on_error)
    text = field(8)
    out = parts.select(
        F.regexp_extract(field(0), r"\((\d+)\)", 1).try_cast("bigint").alias("seconds"),
        field(1).alias("language"),
        field(2).alias("code"),
        field(3).try_cast("bigint").alias("total_retweets"),
        field(4).alias("tweet_id"),
        number(5, "max_count").alias("max_count"),
        number(6, "min_count").alias("min_count"),
        field(7).try_cast("bigint").alias("retweets"),
        (before_first(text, ",") if truncate_text else text).alias("text"),
    )
    return _drop_bad(out, ["tweet_id", "max_count", "min_count"], on_error)


def read_retweet_log(spark: SparkSession, path: str, **options) -> DataFrame:
    return parse_retweet_log(spark.read.text(path), **options)


def retweet_log_lines(rows: DataFrame) -> DataFrame:
    """Log lines of report rows, in the layout that `parse_retweet_log` reads (without the header)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    numbers = ["total_retweets", "tweet_id", "max_count", "min_count", "retweets"]
    seconds = F.concat(F.lit("("), text("seconds"), F.lit(")"))
    return rows.select(
        F.concat_ws(",", seconds, text("language"), text("code"), *map(text, numbers), one_line(text("text"))).alias("value")
    )


def parse_membership(records: DataFrame, group: str) -> DataFrame:
    """`name TAB title TAB title ...` records to (group, person, raw) rows, one per title.

    Empty titles and series (in double quotes) are dropped.
    """
    name, titles = head_and_rest(F.col("value"), "\t")
    return (
        records.select(F.lit(group).alias("group"), name.alias("person"), F.explode(titles).alias("raw"))
        .where((F.trim(F.translate("raw", "\r\n", "  ")) != "") & ~is_series(F.col("raw")))
    )


def with_title(rows: DataFrame) -> DataFrame:
    """Add `movie` (title up to its year) and `year` (NULL when unknown); rows without a year bracket go."""
    # a row per found title: a filter on the title or its year would look for it once more
    found = F.filter(F.transform(F.array("raw"), title_key), lambda movie: movie != "")
    out = rows.withColumn("movie", F.explode(found))
    return out.withColumn("year", title_year(F.col("movie")).try_cast("int")).drop("raw")


def read_membership(spark: SparkSession, path: str, group: str) -> DataFrame:
    """Records separated by a blank line: (group, person, movie, year)."""
    return with_title(parse_membership(spark.read.text(path, lineSep="\n\n"), group))


def read_memberships(spark: SparkSession, male: str, female: str, min_year: int | None = None) -> DataFrame:
    """Both lists in one table; with `min_year`, unknown and earlier years are dropped."""
    both = read_membership(spark, male, "M").unionByName(read_membership(spark, female, "F"))
    return both if min_year is None else both.where(F.col("year") >= min_year)
