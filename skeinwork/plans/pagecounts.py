"""Page counts: total views and the most viewed page of each language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skeinwork.operators.totals import by_total, lang_totals
from skeinwork.sources.sinks import write_report
from skeinwork.sources.text_records import read_pagecounts


def pagecount_report(spark: SparkSession, path: str, on_error: str = "fail") -> DataFrame:
    """Languages in descending order of their views."""
    return by_total(lang_totals(read_pagecounts(spark, path, on_error)))


def run(spark: SparkSession, path: str, out: str) -> None:
    write_report(pagecount_report(spark, path), out)
