import heapq
import random

import pytest

from skeinwork.operators.user_aggregate import aggregate_by_key

SCHEMA = "key string, part int, n bigint, extra string"


def some_rows():
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None, "", "c"]), rng.choice([0, 1, None]), rng.randrange(1000), "x") for _ in range(500)]
    # one key with most of the rows
    return rows + [("hot", 7, i, "x") for i in range(5000)] + [(f"k{i}", i, i, "x") for i in range(300)]


def bounded():
    """A step and a merge that travel by value, as functions of a notebook do."""

    def step(state, rows):
        return heapq.nlargest(3, state + rows.column("n").to_pylist())

    def merge(a, b):
        return heapq.nlargest(3, a + b)

    return step, merge


@pytest.mark.parametrize("how", [{}, {"keys_held": 1}, {"keys_held": 7, "fan": 2}, {"fan": 1}])
def test_bounded_lists(spark, rows, how):
    data = some_rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    got = aggregate_by_key(df, ["key", "part"], list, *bounded(), lambda s: {"top": s, "n": len(s)}, "top array<bigint>, n int", **how)
    want = {}
    for key, part, n, _ in data:
        want.setdefault((key, part), []).append(n)
    assert rows(got) == sorted(((*k, heapq.nlargest(3, v), min(3, len(v))) for k, v in want.items()), key=repr)


def test_a_hot_key_sends_states_not_rows(spark):
    df = spark.range(0, 200_000, 1, 8).selectExpr("0 as key", "id as n")
    sent = spark.sparkContext.accumulator(0)

    def comb(a, b):
        sent.add(1)
        return a + b

    got = aggregate_by_key(df, ["key"], int, lambda s, rows: s + rows.num_rows, comb, lambda s: {"n": s}, "n bigint")
    assert [tuple(r) for r in got.collect()] == [(0, 200_000)]
    assert 1 <= sent.value <= 8


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    got = aggregate_by_key(df, ["key"], list, *bounded(), lambda s: {"n": len(s)}, "n int")
    assert got.count() == 0 and got.columns == ["key", "n"]
