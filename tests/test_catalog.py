"""Every registered query against its SQL on the smallest tables."""

import pathlib

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in pathlib.Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return [columns[i] for i in order], sorted(tuple(text(r[i]) for i in order) for r in rows)


def own(name):
    """The queries of optional parts have tests of their own."""
    return entry.queries()[name].__module__.startswith("skeinwork.catalog.")


@pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(filter(own, entry.queries())))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = duck.execute(entry.oracle_sql()[name])
    want = normal([d[0] for d in result.description], result.fetchall())
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == want
