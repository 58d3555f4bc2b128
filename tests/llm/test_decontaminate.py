import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skeinwork.llm.catalog import _HITS_SQL
from skeinwork.llm.decontaminate import benchmark_hits, drop_contaminated, simhash, within_radius

DOCS = "doc_id long, text string, item_id string, words int, start int"
ITEMS = "item_id long, text string, size int"


def words(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()


def grams(w, k):
    return Counter(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(docs, items):
    """Per hit, the best windows of an item's length anywhere in the text: their starts by what else is reported."""
    found = {}
    for doc in docs:
        d = words(doc[1])
        for item in items:
            b = words(item[1])
            if not b or not d:
                continue
            k, best = min(5, len(b)), None
            want = grams(b, k)
            for start in range(max(1, len(d) - len(b) + 1)):
                w = d[start : start + len(b)]
                got = grams(w, k)
                common = sum((got & want).values())
                total = sum((got | want).values())
                if best is None or common / total > best[0]:
                    best = common / total, set(), len(w), common, total
                if common / total == best[0]:
                    best[1].add(start)
            if 100 * best[3] >= 75 * best[4]:
                found.setdefault((doc[0], item[0], *best[2:]), set()).update(best[1])
    return found


def fixture(seed):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(rng.choice([15, 20, 33, 57]))), 1) for i in range(12)]
    items += [(20, "Only four words here", 1), (21, "solo", 1), (22, None, None), (23, " ", 1), (24, items[3][1].upper(), 1), (None, " ".join(text(25)), 1), (25, "go " * 30, 1)]
    docs = []
    for n in range(120):
        w = text(rng.choice([0, 4, 40, 300]))
        if rng.random() < 0.6:
            passage = words(rng.choice(items)[1])
            passage = [p.decode() for p in passage]
            if passage and rng.random() < 0.5:
                passage[rng.randrange(len(passage))] = "edited"
            if rng.random() < 0.3:
                passage = passage[: len(passage) * 9 // 10]
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage
        docs.append((n, "\n ".join(w), "clash", 1, 1))
    docs += [(500, None, None, None, None), (None, items[0][1], None, None, None), (501, items[1][1] + " word" * 50_000, None, None, None)]
    docs += [docs[3], (3, "same id, other text " + items[2][1], None, None, None)]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    docs, items = fixture(seed)
    got = benchmark_hits(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert got.columns == ["doc_id", "item_id", "start", "n_words", "common", "total", "similarity", "text_key"]
    found, want = {(r[0], r[1], *r[3:6]): r["start"] for r in got.collect()}, brute(docs, items)
    assert set(found) == set(want) and all(start in want[k] for k, start in found.items())


def test_cut_items_and_words_put_in_against_sql(spark):
    """No bound on fingerprints: items without their last tenth, and with words put in, as far as the SQL finds them."""
    duckdb = pytest.importorskip("duckdb")
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, text(rng.randrange(15, 60))) for i in range(60)]
    docs = []
    for _, item in items:
        for _ in range(4):
            lost = max(1, len(item) // 10)
            docs.append(text(40) + item[:-lost] + text(40))
            at = rng.randrange(5, len(item) - 5)
            docs.append(text(40) + item[:at] + text(rng.randrange(1, 1 + max(1, len(item) // 7))) + item[at:] + text(40))
    docs = spark.createDataFrame([(n, " ".join(d), None, None, None) for n, d in enumerate(docs)], DOCS)
    benchmark = spark.createDataFrame([(i, " ".join(b), None) for i, b in items], ITEMS)
    con = duckdb.connect()
    for name, frame in (("documents", docs), ("benchmark", benchmark)):
        con.register(name, frame.toArrow())
    result = con.execute(_HITS_SQL)
    columns = [d[0] for d in result.description]
    want = sorted(result.fetchall())
    got = benchmark_hits(docs, benchmark)
    assert sorted(tuple(r) for r in got.select(columns).collect()) == want
    assert len(want) > 240      # the cut ones alone
    assert benchmark_hits(docs, benchmark, radius=12).count() < len(want)


def test_drop(spark):
    docs, items = fixture(7)
    df, benchmark = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    hit = {(h[0], d[1]) for h in brute(docs, items) for d in docs if d[0] == h[0] and brute([d], items)}
    left = drop_contaminated(df, benchmark)
    assert left.columns == df.columns
    assert sorted((tuple(r) for r in left.collect()), key=repr) == sorted((d for d in docs if (d[0], d[1]) not in hit), key=repr)


def test_empty(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b c", 1)], ITEMS)
    assert benchmark_hits(docs, items).count() == 0 and benchmark_hits(docs, some).count() == 0
    assert benchmark_hits(spark.createDataFrame([(1, "a b c", None, None, None)], DOCS), items).count() == 0
    assert drop_contaminated(docs, some).count() == 0


def test_every_fingerprint_within_the_radius(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(20)]
    near = [(k, base[k % 20]) for k in range(200)]
    for i, (k, value) in enumerate(near):
        for b in rng.sample(range(64), rng.randrange(16)):
            value ^= 1 << b
        near[i] = (k, value)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    items = spark.createDataFrame([(i, signed(v)) for i, v in enumerate(base)], "item long, print long")
    windows = spark.createDataFrame([(k, signed(v)) for k, v in near], "win long, print long")
    for radius in (0, 3, 12):
        got = {tuple(r) for r in within_radius(windows, items, radius).collect()}
        assert got == {(k, i) for k, v in near for i, b in enumerate(base) if (v ^ b).bit_count() <= radius}


def test_simhash_is_the_majority(spark):
    df = spark.createDataFrame([(1, ["a", "b", "b"]), (2, ["c"])], "k int, words array<string>")
    hashes = {r["w"]: r["h"] for r in df.select(F.explode("words").alias("w")).distinct().select("w", F.xxhash64("w").alias("h")).collect()}
    got = {r["k"]: r["print"] for r in simhash(df, "k", "words").collect()}
    assert got == {1: hashes["b"], 2: hashes["c"]}


def test_plan_has_no_python(spark):
    docs, items = fixture(0)
    plan = benchmark_hits(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
