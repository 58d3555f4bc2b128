import hashlib

import pytest
from pyspark.sql import functions as F

from skeinwork.llm.exact_dedup import drop_copies, exact_dedup

SCHEMA = "doc_id long, text string, key string, row int, body string"
ROWS = [
    (1, "a", "x", 1, None), (2, "a", "x", 2, "b"), (3, "b", None, 3, "b"), (4, None, "y", 4, None), (5, "", "y", 5, None),
    (6, "A", "x", 6, None), (None, "solo", "n", 7, None), (7, "w " * 50_000, "l", 8, None), (8, "w " * 50_000, "l", 9, None),
    (9, "same", "s", 10, None), (9, "same", "s", 10, None), (None, "twin", "t", 11, None), (10, "twin", "t", 12, None),
]


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    out = []
    for r in rows:
        ids = groups[r[1] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("weak", [False, True])
def test_flags(spark, rows, weak):
    df = spark.createDataFrame(ROWS, SCHEMA)
    # with a weak hash, different texts share a group and must be told apart by their bytes
    found = exact_dedup(df, hash_of=lambda body: F.substring(F.sha2(body, 256), 1, 0)) if weak else exact_dedup(df)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows(found) == brute(ROWS)


def test_drop_copies(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept = drop_copies(df)
    assert kept.columns == df.columns
    got = [(r["doc_id"], r["row"]) for r in kept.collect()]
    assert sorted(got, key=repr) == sorted([(2, 2), (3, 3), (5, 5), (6, 6), (None, 7), (8, 9), (9, 10), (10, 12)], key=repr)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_dedup(df).count() == 0 and drop_copies(df).count() == 0


def test_plan_has_no_python(spark):
    plan = exact_dedup(spark.createDataFrame(ROWS, SCHEMA).select("doc_id", "text"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
