"""The corpus queries on the smallest tables: against their SQL, and the pipeline against a brute-force version."""

import hashlib
import pathlib
import random
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from skeinwork.llm.bpe import load_ranks  # noqa: E402
from skeinwork.llm.catalog import pattern, vocabulary  # noqa: E402
from skeinwork.llm.language_id import MARGIN, UNKNOWN, Classifier, fit_dictionaries, is_held_out  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="test tables are not here")


def words(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()


def test_all_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and [name for name, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "decontamination", "bpe"]


@pytest.mark.parametrize("name", ["op1_ngram_jaccard", "op6_exact_dedup", "op9_decontamination", "op12_centroid_clustering", "op13_fill_in_middle"])
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in pathlib.Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    cell = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    want = sorted(tuple(map(cell, r)) for r in result.fetchall())
    got = entry.queries()[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(cell(r[c]) for c in columns) for r in got.collect()) == want


def near_copies(rows):
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := words(t)) else set() for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) > 0:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i for i in ids if find(i) != i}


def contaminated(text, items):
    d = words(text)
    for item in items:
        b = words(item)
        want = Counter(tuple(b[i : i + 5]) for i in range(len(b) - 4))
        shared = [k for k in range(len(d) - 4) if tuple(d[k : k + 5]) in want]
        for start in range(max(0, min(shared, default=0) - len(b)), max(shared, default=-1) + 1):
            w = d[start : start + len(b)]
            got = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
            if 100 * sum((got & want).values()) >= 75 * sum((got | want).values()) > 0:
                return True
    return False


def test_pipeline_against_brute_force(spark):
    import tiktoken

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    classify = Classifier(fit_dictionaries(docs.where(~is_held_out(docs["doc_id"]))))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    clear = []
    for i, t in rows:
        lang, score = classify(t)
        if lang != UNKNOWN and score >= MARGIN:
            clear.append((i, t))
    newest = {}
    for i, t in clear:
        newest[t] = max(newest.get(t, i), i)
    single = sorted((i, t) for t, i in newest.items())
    gone = near_copies(single)
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    left = [(i, t) for i, t in single if i not in gone and not contaminated(t, items)]
    library = tiktoken.Encoding("t", pat_str=pattern(), mergeable_ranks=load_ranks(vocabulary("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = []
    for i, t in left:
        ids = np.array(library.encode_ordinary(t), "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert len(rows) * 0.7 < len(left) < len(rows)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "", None, None, 0), (None, "the and of to", "en", None, 1)], docs.schema)
    for frame in (docs.limit(30).unionByName(odd), docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, SF_DIR)
            assert frame.columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, frame, SF_DIR).count()


def test_extra_columns_and_odd_rows_pass_the_stages(spark):
    """Columns with the names that the operators use inside, null and repeated rows, equal texts, a very long text."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 120")
    long = docs.where("lang = 'en'").agg(F.max_by("text", F.length("text"))).first()[0]
    mixed, rng = long.split(" "), random.Random(4)
    very_long = " ".join(" ".join(rng.sample(mixed, len(mixed))) for _ in range(6))
    odd = [(9001, None, None, None, None), (9002, "", "en", None, 0), (None, long + " with no id", "en", None, 1), (9003, long + " twice", "en", "s", 1),
           (9003, long + " twice", "en", "s", 1), (9004, long + " twice", None, "s", 1), (9005, very_long, "en", "s", 1)]
    names = ["row", "id", "key", "body", "set", "label", "words", "keep", "language", "n", "item", "start", "text_key", "wanted"]
    frame = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumns({n: F.lit(f"own {n}") for n in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, frame, SF_DIR)
        assert after.columns == frame.columns
        assert after.select(names).distinct().collect() == [tuple(f"own {n}" for n in names)]
        frame = after
    left = [r["doc_id"] for r in frame.where("doc_id is null or doc_id > 9000").collect()]
    # the copies of the longest text go with it: the one with the smallest id stays
    assert left == [9005]
    tokens = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.STAGES[-1][1](spark, frame, SF_DIR).collect()}
    assert tokens[9005] > 1000 and len(tokens) == frame.select("doc_id").distinct().count()


def test_a_stage_gets_smaller_batches_and_gives_the_setting_back(spark):
    p = corpus_pipeline
    own = spark.conf.get(p.BATCH_CONF)
    try:
        with p.batches_of(spark, p.TEXTS_AT_ONCE["bpe"]):
            assert int(spark.conf.get(p.BATCH_CONF)) <= 1000
        assert spark.conf.get(p.BATCH_CONF) == own
        spark.conf.set(p.BATCH_CONF, "10")      # smaller than the stage asks for: stays
        with p.batches_of(spark, 1000):
            assert spark.conf.get(p.BATCH_CONF) == "10"
        with pytest.raises(ZeroDivisionError), p.batches_of(spark, 5):
            1 / 0
        assert spark.conf.get(p.BATCH_CONF) == "10"
    finally:
        spark.conf.set(p.BATCH_CONF, own)
