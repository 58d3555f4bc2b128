"""Stream source for retweet records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RETWEET_SCHEMA = "ts timestamp, is_retweet boolean, retweeted_id bigint, retweet_count bigint, text string"


def read_stream(
    spark: SparkSession,
    path: str | None = None,
    format: str = "json",
    schema: str = RETWEET_SCHEMA,
    **options: str,
) -> DataFrame:
    """Unbounded records from any Structured Streaming source with a declared schema."""
    reader = spark.readStream.format(format).schema(schema).options(**options)
    return reader.load(path) if path else reader.load()


def retweets_only(stream: DataFrame) -> DataFrame:
    return stream.where(F.col("is_retweet") & F.col("retweeted_id").isNotNull())
