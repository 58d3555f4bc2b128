"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skeinwork.session import materialize

LEAST_ROWS = 20_000             # a key with fewer rows is never cut
SPREAD_BYTES = 2 << 30          # an input with at most so many bytes may be dealt out anew


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when the scan has fewer splits than that; else `df` as it is.

    For work that is heavy per row on a small input of few splits, such as a
    file with one row group. Splits have a size bound, so their number bounds
    the bytes; a larger input is left alone.
    """
    spark = df.sparkSession
    cores, splits = spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    largest = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return df.repartition(cores) if splits < cores and splits * largest <= SPREAD_BYTES else df


def task_rows(spark: SparkSession, rows: int, least: int | None = None) -> int:
    """Rows that a task of a shuffle gets when they are dealt out evenly, `least` (`LEAST_ROWS`) at least."""
    return max(LEAST_ROWS if least is None else least, -(-rows // int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _cut(counts: DataFrame, keys: list[str], rows: int, least: int | None) -> DataFrame:
    """Keys with more rows (`_n`) than a task should get, and the pieces to cut them into."""
    share = task_rows(counts.sparkSession, rows) if least is None else task_rows(counts.sparkSession, rows, least)
    return counts.where(F.col("_n") > share).select(*keys, F.ceil(F.col("_n") / share).cast("int").alias("_pieces"))


def hot_keys(df: DataFrame, keys: list[str], least: int | None = None) -> DataFrame | None:
    """(keys, `_pieces`) of the keys with more rows than a task's share; None when there are none.

    There are fewer of them than shuffle partitions, so the result may be
    broadcast. The count is combined on the map side; all rows are added up in
    the same pass. Give `least` where rows are dear: the number that is cut first.
    """
    seen = Observation()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).observe(seen, F.sum("_n").alias("rows"))
    hot = _cut(materialize(counts.where(F.col("_n") > (LEAST_ROWS if least is None else least)), "key_counts"), keys, seen.get["rows"] or 0, least)
    return None if hot.isEmpty() else hot


def hot_among(counts: DataFrame, keys: list[str], least: int | None = None) -> DataFrame | None:
    """`hot_keys` from a table that has the rows per key as `_n`."""
    hot = _cut(counts, keys, counts.agg(F.sum("_n")).first()[0] or 0, least)
    return None if hot.isEmpty() else hot


def same_keys(keys: list[str], other: str) -> Column:
    """Null-safe equality of each key with the column of that name behind a prefix."""
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{other}{k}")) for k in keys])


def _prefixed(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: f"{prefix}{k}" for k in keys})


def _pieces(df: DataFrame, keys: list[str], hot: DataFrame | None, out: str) -> DataFrame:
    if hot is None:
        return df.withColumn(out, F.lit(1))
    marks = F.broadcast(_prefixed(hot, keys, "_hot_"))
    joined = df.join(marks, same_keys(keys, "_hot_"), "left").withColumn(out, F.coalesce("_pieces", F.lit(1)))
    return joined.drop("_pieces", *(f"_hot_{k}" for k in keys))


def cut_hot(df: DataFrame, keys: list[str], hot: DataFrame | None, spread_by: list[str], out: str = "_piece") -> DataFrame:
    """Adds the piece of each row: that of a hash of `spread_by` for the hot keys, 0 for others."""
    if hot is None:
        return df.withColumn(out, F.lit(0))
    return _pieces(df, keys, hot, "_n").withColumn(out, F.pmod(F.xxhash64(*spread_by), F.col("_n")).cast("int")).drop("_n")


def repeat_hot(df: DataFrame, keys: list[str], hot: DataFrame | None, out: str = "_piece") -> DataFrame:
    """Rows once per piece of their key, to be joined with rows from `cut_hot` on the keys and the piece."""
    if hot is None:
        return df.withColumn(out, F.lit(0))
    return _pieces(df, keys, hot, "_n").withColumn(out, F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread_left: list[str],
    hot_left: DataFrame | None = None,
    spread_right: list[str] | None = None,
    hot_right: DataFrame | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Inner equi-join in which hot keys are cut into pieces; NULL keys match each other.

    With `partitions`, the pieces are dealt out to so many tasks, which Spark
    does not put together again by their bytes; the keys must hold no NULL then.

    Rows of one side with a key that is hot there get a piece from a hash of
    their spread columns; the rows of the other side with that key are repeated
    once per piece. The hot keys come from `hot_keys`. Every pair of matching
    rows meets exactly once.
    """
    def own(pieces: str, spread_by: list[str] | None) -> Column:
        return F.pmod(F.xxhash64(*spread_by), F.col(pieces)).cast("int") if spread_by else F.lit(0)

    def repeated(pieces: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(pieces) - 1))

    other = _prefixed(right, keys, "_right_")
    if hot_left is None and hot_right is None and partitions is None:
        return left.join(other, same_keys(keys, "_right_")).drop(*(f"_right_{k}" for k in keys))
    a = _pieces(_pieces(left, keys, hot_left, "_l"), keys, hot_right, "_r")
    a = a.withColumn("_salt_left", own("_l", spread_left)).withColumn("_salt_right", repeated("_r")).drop("_l", "_r")
    b = _pieces(_pieces(right, keys, hot_left, "_l"), keys, hot_right, "_r")
    b = b.withColumn("_salt_right", own("_r", spread_right)).withColumn("_salt_left", repeated("_l")).drop("_l", "_r")
    every = [*keys, "_salt_left", "_salt_right"]
    b = _prefixed(b, every, "_right_")
    if partitions is None:
        joined = a.join(b, same_keys(every, "_right_"))
    else:
        a, b = a.repartition(partitions, *every), b.repartition(partitions, *(f"_right_{k}" for k in every))
        joined = a.join(b.hint("merge"), reduce(Column.__and__, [F.col(k) == F.col(f"_right_{k}") for k in every]))
    return joined.drop("_salt_left", "_salt_right", *(f"_right_{k}" for k in every))


def group_totals(detail: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Sum of `value` per key as `out`, and the rows of the key as `_n`; combined on the map side."""
    return detail.groupBy(*keys).agg(F.sum(value).alias(out), F.count(F.lit(1)).alias("_n"))


def join_totals(detail: DataFrame, totals: DataFrame, keys: list[str], spread_by: list[str]) -> DataFrame:
    """The totals of `group_totals` next to every detail row, NULL keys included.

    The hot keys are known from the totals. The join cuts those keys into
    pieces, where a window over the key would hold all their rows in one task.
    """
    return salted_join(detail, totals.drop("_n"), keys, spread_by, hot_among(totals, keys))


def with_group_totals(detail: DataFrame, keys: list[str], value: str, out: str, spread_by: list[str]) -> DataFrame:
    """Sum of `value` per key put next to every detail row.

    `detail` is read twice: pass a materialised table when it is costly.
    """
    return join_totals(detail, materialize(group_totals(detail, keys, value, out), "totals"), keys, spread_by)
