"""Identity of people that come from several lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_group_id(df: DataFrame, group: str = "group", person: str = "person", out: str = "person_id") -> DataFrame:
    """`group:person`: the same name in two lists is two people."""
    return df.withColumn(out, F.concat(F.col(group), F.lit(":"), F.col(person)))
