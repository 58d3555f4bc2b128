"""Records made of several lines, and the interleaving of two mate files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_lines(lines: DataFrame, keys: list[str]) -> DataFrame:
    """One row per record: its lines in (mate, line_no) order.

    A record has a fixed number of lines, so the list is bounded.
    """
    item = F.struct("mate", "line_no", "line")
    ordered = F.sort_array(F.collect_list(item))
    return lines.groupBy(*keys).agg(F.transform(ordered, lambda x: x["line"]).alias("lines"))


def interleave(mate1: DataFrame, mate2: DataFrame, *keys: str) -> DataFrame:
    """Records of two mates merged by `keys` (`rec` by default), mate 1 before mate 2.

    Inputs have the keys, line_no and line. Returns the keys and `record`, the
    lines as text; sort by the keys, or hand it to `write_chunks`.
    """
    keys = list(keys or ["rec"])
    both = mate1.withColumn("mate", F.lit(1)).unionByName(mate2.withColumn("mate", F.lit(2)))
    return group_lines(both, keys).select(*keys, F.array_join("lines", "\n").alias("record"))
