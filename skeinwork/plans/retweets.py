"""Retweet totals from the log that the stream writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.operators.counters import retweet_delta, retweet_report
from skeinwork.sources.sinks import write_report
from skeinwork.sources.text_records import read_retweet_log


def log_report(spark: SparkSession, path: str, more_than: int = 1, **options) -> DataFrame:
    """Tweets counted more than `more_than` times, with the total of their language."""
    log = read_retweet_log(spark, path, **options)
    delta = retweet_delta(log, "tweet_id", "max_count", "min_count", ["language", "code", "text"], ["seconds", "text"])
    report = retweet_report(delta, "code", more_than)
    return report.select("language", "code", "total_retweets", "tweet_id", "retweets", "text").orderBy(
        F.desc("total_retweets"), F.desc("retweets"), "tweet_id"
    )


def run(spark: SparkSession, path: str, out: str) -> None:
    write_report(log_report(spark, path), out)
