import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from skeinwork.operators import regions as rg
from skeinwork.operators import skew
from skeinwork.operators.numbering import global_index
from skeinwork.operators.duplicates import duplicate_metrics, mark_duplicates


def data(spark, n=1003):
    rnd = random.Random(1)
    rows = [(i, 5 if i % 3 == 0 else rnd.randrange(-1, 25), rnd.randrange(50)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id bigint, ref_index int, pos int").repartition(5)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] == -1, r[1], r[2], r[0]))


def test_global_index(spark):
    rows, df = data(spark)
    indexed = global_index(df, rg.coordinate_order("ref_index", "pos", "id"), total="n", partitions=7)
    got = {r["id"]: r["idx"] for r in indexed.collect()}
    assert got == {r[0]: i for i, r in enumerate(in_order(rows))}
    assert indexed.select("n").distinct().collect()[0][0] == len(rows)
    assert [r["id"] for r in rg.coordinate_sort(df, "ref_index", "pos", "id").collect()] == [r[0] for r in in_order(rows)]


def test_balanced_regions(spark):
    rows, df = data(spark)
    order = rg.coordinate_order("ref_index", "pos", "id")
    for n in (1, 4, 7, 2000):
        got = {r["id"]: r["region"] for r in rg.balance_regions(df, order, n).collect()}
        sizes = pd.Series(got).value_counts()
        assert sizes.max() - sizes.min() <= 1 and len(sizes) == min(n, len(rows))
        numbers = [got[r[0]] for r in in_order(rows)]
        assert numbers == sorted(numbers) and numbers[0] == 0
    bounded = rg.balance_regions(df, order, rows_per_region=100)
    assert bounded.groupBy("region").count().agg(F.max("count")).first()[0] <= 100


def test_region_apply_streams_sorted_chunks(spark):
    rows, df = data(spark)

    def positions(chunks):
        seen = 0
        for chunk in chunks:
            yield pd.DataFrame({"id": chunk["id"], "at": range(seen, seen + len(chunk))})
            seen += len(chunk)

    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "40")
    try:
        order = rg.coordinate_order("ref_index", "pos", "id")
        regions = rg.balance_regions(df, order, 3)
        got = {r["id"]: r["at"] for r in rg.region_apply(regions, "region", order, positions, "id bigint, at bigint").collect()}
    finally:
        spark.conf.set(setting, before)
    sizes = [335, 334, 334]
    want, start = {}, 0
    for size in sizes:
        want.update({r[0]: i for i, r in enumerate(in_order(rows)[start:start + size])})
        start += size
    assert got == want


def test_chunks_and_ranges(spark):
    _, df = data(spark)
    doubled = rg.chunk_apply(df, lambda c: pd.DataFrame({"x": pd.concat([c["id"], c["id"]])}), "x bigint")
    assert doubled.count() == 2006
    parts = rg.range_partitioned(df, 4, "id").withColumn("p", F.spark_partition_id())
    ends = parts.groupBy("p").agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("p").collect()
    assert len(ends) == 4 and all(x["b"] < y["a"] for x, y in zip(ends, ends[1:]))


def test_salted_join_equals_plain_join(spark, rows, monkeypatch):
    monkeypatch.setattr(skew, "LEAST_ROWS", 50)
    rnd = random.Random(2)
    left = spark.createDataFrame([(1 if i % 3 == 0 else rnd.randrange(300), i) for i in range(900)], "k int, a int")
    right = spark.createDataFrame([(2 if i % 2 == 0 else rnd.randrange(300), i) for i in range(500)], "k int, b int")
    hot_l, hot_r = skew.hot_keys(left, ["k"]), skew.hot_keys(right, ["k"])
    assert rows(hot_l) == [(1, 2)] and [r[0] for r in hot_r.collect()] == [2]
    got = skew.salted_join(left, right, ["k"], ["a"], hot_l, ["b"], hot_r)
    assert rows(got) == rows(left.join(right, "k"))
    assert skew.hot_keys(spark.range(1000), ["id"]) is None
    totals = skew.with_group_totals(left, ["k"], "a", "t", ["a"])
    want = dict(rows(left.groupBy("k").agg(F.sum("a"))))
    assert totals.count() == 900 and all(r["t"] == want[r["k"]] for r in totals.collect())


@pytest.mark.parametrize("least", [1, 1000])
def test_null_keys_are_kept(spark, rows, monkeypatch, least):
    monkeypatch.setattr(skew, "LEAST_ROWS", least)
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), (None, "x", 3), (None, None, 4), ("b", "y", 5)], "k string, w string, v int")
    got = skew.with_group_totals(df, ["k", "w"], "v", "t", ["v"])
    assert rows(got) == [("a", None, 1, 3), ("a", None, 2, 3), ("b", "y", 5, 5), (None, "x", 3, 3), (None, None, 4, 4)]
    hot = skew.hot_keys(df, ["k"])
    assert rows(skew.salted_join(df.select("k", "v"), df.select("k", "w"), ["k"], ["v"], hot, ["w"], hot)) == rows(
        df.alias("a").join(df.alias("b"), F.col("a.k").eqNullSafe(F.col("b.k"))).select("a.k", "a.v", "b.w")
    )


def test_no_task_gets_a_hot_key_whole(spark, monkeypatch):
    """A key with 60 % of the rows and one with 1 %, over 40 partitions of 1,000 rows each."""
    monkeypatch.setattr(skew, "LEAST_ROWS", 100)
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") < 24_000, F.lit(-1)).when(F.col("id") < 24_400, F.lit(-2)).otherwise(F.col("id"))
        df = spark.range(40_000).select(key.alias("k"), "id")
        assert {r["k"]: r["_pieces"] for r in skew.hot_keys(df, ["k"]).collect()} == {-1: 24}
        joined = skew.with_group_totals(df, ["k"], "id", "t", ["id"])
        most = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert joined.count() == 40_000 and most <= 6_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_duplicates(spark, rows):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 7), (3, "a", 7), (4, "b", 1)], "id int, k string, s int")
    marked = mark_duplicates(df, ["k"], "s", "id")
    assert rows(marked.select("id", "is_duplicate")) == [(1, True), (2, False), (3, True), (4, False)]
    unscored = spark.createDataFrame([(1, "a", None), (2, "a", 1), (3, "b", None)], "id int, k string, s int")
    assert rows(mark_duplicates(unscored, ["k"], "s", "id").select("id", "is_duplicate")) == [(1, True), (2, False), (3, False)]
    assert rows(duplicate_metrics(marked)) == [(4, 2, 50.0)]


def test_two_streams_of_a_region_larger_than_a_batch(spark, rows):
    """What a function holds at once is a batch of either table, however many rows the region has."""
    import pyarrow as pa

    left = spark.range(120_000).selectExpr("cast(if(id < 110000, 1, 2) as int) as region", "119999 - id as pos", "'x' as region_name")
    right = spark.range(30_000).selectExpr("cast(if(id < 25000, 1, 3) as int) as region", "29999 - id as at")

    def fn(second, first):
        def seen(batches, column):
            n, largest, last, ordered = 0, 0, -1, True
            for b in batches:
                values = b.column(column).to_pylist()
                ordered = ordered and all(x <= y for x, y in zip([last, *values], values))
                n, largest, last = n + len(values), max(largest, len(values)), values[-1]
            return n, largest, ordered

        r, l = seen(second, "at"), seen(first, "pos")
        yield pa.RecordBatch.from_pydict({"r": [r[0]], "l": [l[0]], "largest": [max(r[1], l[1])], "ok": [r[2] and l[2]]})

    got = rg.region_apply_streams(left, right, "region", ["pos"], ["at"], fn, "r bigint, l bigint, largest bigint, ok boolean").collect()
    assert sorted((x["r"], x["l"], x["ok"]) for x in got) == [(0, 10_000, True), (5_000, 0, True), (25_000, 110_000, True)]
    assert max(x["largest"] for x in got) <= int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))

    def wrong_order(second, first):
        yield from first

    with pytest.raises(Exception, match="right table come first"):
        rg.region_apply_streams(left.limit(5), right.limit(5), "region", ["pos"], ["at"], wrong_order, "pos bigint, region_name string").collect()


def test_ranges_are_looked_at_in_blocks(spark, tmp_path, monkeypatch):
    """Rows out of order are found inside a block and at its border; equal rows are in order."""
    from skeinwork.catalog import genome
    from skeinwork.catalog.registry import QUERIES

    rows = [(i * 37 % 101, i % 5, 1) for i in range(200)] + [(7, 1, 1)] * 30 + [(None, 1, 1)] * 3
    spark.createDataFrame(rows, "l_partkey bigint, l_orderkey bigint, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))
    total = sum(r[0] or 0 for r in rows)
    monkeypatch.setattr(genome, "BLOCK_ROWS", 7)
    assert QUERIES["range_partitions"](spark, str(tmp_path)).collect() == [(233, total, 6, True)]
    cut = genome.range_partitioned
    monkeypatch.setattr(genome, "range_partitioned", lambda df, n, *columns: cut(df, n, *columns).sortWithinPartitions("l_orderkey"))
    assert QUERIES["range_partitions"](spark, str(tmp_path)).first()["in_order"] is False
    monkeypatch.setattr(genome, "BLOCK_ROWS", 1)
    assert QUERIES["range_partitions"](spark, str(tmp_path)).first()["in_order"] is False
