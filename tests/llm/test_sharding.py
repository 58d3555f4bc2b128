import zlib

from skeinwork.llm.sharding import shard_by_bytes

SCHEMA = "doc_id long, text string, shard string, size string"


def brute(rows, n):
    cells = sorted(((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for i, t, *_ in rows))
    total, start, out, slots = sum(c[3] for c in cells), 0, [], {}
    for known, i, crc, size in cells:
        shard = min(n - 1, (2 * start + size) * n // (2 * total))
        out.append((i if known else None, size, crc, "bytes", shard, slots.get(shard, 0), None))
        slots[shard] = slots.get(shard, 0) + 1
        start += size
    return sorted(out, key=repr)


def test_against_brute_force(spark, rows):
    data = [(i, "é" * (i * 37 % 101), "x", None) for i in range(500)]
    data += [(None, "n", None, None), (None, None, None, None), (7, "é" * (7 * 37 % 101), "x", None), (900, "long " * 3000, None, "y"), (901, "", None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    for n in (1, 3, 24, 700):
        for per in (10_000, 40):
            assert rows(shard_by_bytes(df, n, rows_per_partition=per)) == brute(data, n)


def test_near_equal(spark):
    data = [(i, "x" * (i % 50), None, None) for i in range(2000)]
    got = shard_by_bytes(spark.createDataFrame(data, SCHEMA), 24).groupBy("shard").sum("size").collect()
    sums = [r[1] for r in got]
    assert len(sums) == 24 and max(sums) - min(sums) <= 2 * 58


def test_empty(spark):
    assert shard_by_bytes(spark.createDataFrame([], SCHEMA), 24).count() == 0
