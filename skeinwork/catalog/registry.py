"""Registry of the queries and of the SQL that gives the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL when there is one."""

    def add(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the tables hold times without a zone: read them as UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch(unit: str, ts: Column) -> Column:
    """Whole units since 1970 of a timestamp without time zone."""
    return F.timestamp_diff(unit, F.expr("timestamp_ntz'1970-01-01 00:00:00'"), ts)
