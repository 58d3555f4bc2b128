"""Film titles of the form `Name (sub) (2014/II) (TV) [role] <3>`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TITLE_PATTERN = r"(?s)^(.*?\((?:\d{4}|\?{4})[^)]*\))"
YEAR_PATTERN = r"\((\d{4}|\?{4})[^(]*$"


def title_key(raw: Column) -> Column:
    """Title up to the bracket that closes its year; '' when there is no year."""
    return F.regexp_extract(raw, TITLE_PATTERN, 1)


def title_year(title: Column) -> Column:
    """The four characters after the last opening bracket: a year or `????`."""
    return F.regexp_extract(title, YEAR_PATTERN, 1)


def is_series(raw: Column) -> Column:
    """Series titles are written in double quotes."""
    return raw.contains('"')
