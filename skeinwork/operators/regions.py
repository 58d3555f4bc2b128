"""Even regions over sorted reads, coordinate order, user functions per region or chunk."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.functions.coords import reference_order
from skeinwork.operators.numbering import global_index


def region_of(index: Column, total: Column, n: int) -> Column:
    """Region of a 0-based index: the first total % n regions hold one row more."""
    small = F.floor(total / F.lit(n)).cast("bigint")
    extra = total - small * n
    in_large = extra * (small + 1)
    past = F.floor(F.try_divide(index - in_large, small)).cast("bigint")
    return F.when(index < in_large, F.floor(index / (small + 1)).cast("bigint")).otherwise(extra + past).cast("int")


def balance_regions(
    df: DataFrame,
    order: list[str | Column],
    n: int | None = None,
    rows_per_region: int | None = None,
    name: str = "region",
) -> DataFrame:
    """Cut the rows, in the given order, into regions whose sizes differ by at most one.

    Give the number of regions, or a bound on the rows of one. No row list and
    no region list is held by the driver: the region is arithmetic on the
    global index.
    """
    indexed = global_index(df, order, "_idx", total="_rows")
    if n is None:
        count = F.ceil(F.col("_rows") / F.lit(rows_per_region)).cast("bigint")
    else:
        count = F.lit(n)
    return indexed.withColumn(name, region_of(F.col("_idx"), F.col("_rows"), count)).drop("_idx", "_rows")


def coordinate_order(ref_index: str = "ref_index", pos: str = "pos", *ties: str) -> list[Column]:
    """Reference, then position, unmapped last; add ties for a total order."""
    return [*reference_order(F.col(ref_index)), F.col(pos), *(F.col(t) for t in ties)]


def coordinate_sort(df: DataFrame, ref_index: str = "ref_index", pos: str = "pos", *ties: str) -> DataFrame:
    """Global coordinate order: one range shuffle."""
    return df.orderBy(*coordinate_order(ref_index, pos, *ties))


def range_partitioned(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """Contiguous ranges of the columns in n sorted partitions."""
    return df.repartitionByRange(n, *columns).sortWithinPartitions(*columns)


def sorted_within(df: DataFrame, group: str, order: list[str | Column]) -> DataFrame:
    """Rows of a group together and in order; no sort across groups."""
    return df.repartition(group).sortWithinPartitions(group, *order)


def chunk_apply(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """User function from one chunk of rows to many rows, without a shuffle."""

    def run(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            yield fn(chunk)

    return df.mapInPandas(run, schema)


def region_apply(
    df: DataFrame,
    region: str,
    order: list[str | Column],
    fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: str,
) -> DataFrame:
    """User function over the rows of one region, sorted, as a stream of chunks.

    A region arrives in Arrow batches, so it never has to fit in memory at
    once; use `balance_regions` first to make regions even.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from fn(batches)

    # real types, not the strings that the module-level annotations have become
    run.__annotations__ = {"batches": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    return sorted_within(df, region, order).groupBy(region).applyInPandas(run, schema)


def region_apply_with(
    left: DataFrame,
    right: DataFrame,
    region: str,
    left_order: list[str],
    right_order: list[str],
    fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """User function over two tables' rows of one region, each in order, as pandas frames.

    For regions of bounded size (`balance_regions` with `rows_per_region`);
    a region without rows on one side gets an empty frame there.
    """

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return fn(a.sort_values(left_order, ignore_index=True), b.sort_values(right_order, ignore_index=True))

    return left.groupBy(region).cogroup(right.groupBy(region)).applyInPandas(run, schema)


def region_apply_streams(
    left: DataFrame,
    right: DataFrame,
    region: str,
    left_order: list[str],
    right_order: list[str],
    fn: Callable[[Iterator[pa.RecordBatch], Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """User function over two tables' rows of one region, each in order, as streams of Arrow batches.

    `fn(right, left)` must read what it needs of `right` before `left`: the rows
    of both lie in one sorted stream, those of `right` first, so neither table's
    region has to fit in memory. What `fn` keeps of the right rows is up to it.
    A region without rows on one side gets an empty stream there.
    """
    sides = [(right, "_r"), (left, "_l")]
    kinds = {name: df.drop(region).schema.simpleString() for df, name in sides}

    def packed(df: DataFrame, own: str, side: int) -> DataFrame:
        rest = [F.lit(None).cast(kinds[name]).alias(name) if name != own else F.struct(*[df[c] for c in df.columns if c != region]).alias(name) for _, name in sides]
        return df.select(df[region].alias(region), F.lit(side).alias("_side"), *rest)

    both = packed(right, "_r", 0).unionByName(packed(left, "_l", 1))
    order = ["_side", *(f"_r.{c}" for c in right_order), *(f"_l.{c}" for c in left_order)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(*_two_streams(batches))

    run.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return sorted_within(both, region, order).groupBy(region).applyInArrow(run, schema)


def _two_streams(batches: Iterator[pa.RecordBatch]) -> tuple[Iterator[pa.RecordBatch], Iterator[pa.RecordBatch]]:
    """The rows of side 0 and of side 1 of a sorted stream, each as batches of its own columns."""
    waiting: list[pa.RecordBatch] = []

    def rows(batch: pa.RecordBatch, side: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_struct_array(batch.column("_r" if side == 0 else "_l"))

    def right() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = batch.column("_side")
            n = sides.to_numpy().searchsorted(1)
            if n < batch.num_rows:
                waiting.append(batch.slice(n))
            if n:
                yield rows(batch.slice(0, n), 0)
            if waiting:
                break

    first = right()

    def left() -> Iterator[pa.RecordBatch]:
        for _ in first:
            raise RuntimeError("the rows of the right table come first: read them before the left ones")
        while waiting:
            yield rows(waiting.pop(), 1)
        for batch in batches:
            yield rows(batch, 1)

    return first, left()
