import random

import numpy as np
import pyarrow as pa
import pytest

from skeinwork.llm import ngram_join
from skeinwork.llm.components import components
from skeinwork.llm.ngram_join import jaccard_components, shared_runs, tile_links

SCHEMA = "doc_id long, text string, n_links string, element long"


def words(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()


def brute(rows, percent=75):
    sets = []
    for r in rows:
        w = words(r[1])
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i)), links[i]) for i, r in enumerate(rows)), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, rows, n = text(40), [], 0
    for _ in range(12):
        base = text(rng.choice([1, 3, 5, 9, 30, 60, 200]))
        for _ in range(rng.choice([1, 2, 5, 25])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                own = own + text(rng.randrange(1, 1 + max(1, len(own) // 3)))
            if rng.random() < 0.2:
                own = passage + own
            rows.append((n, "\t ".join(own) if rng.random() < 0.5 else " ".join(own).upper(), "x", 1))
            n += 1
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, rows, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 4)
    monkeypatch.setattr(ngram_join, "LOW_SHARE", (0.4, 0.05, 1.0)[seed])
    monkeypatch.setattr(ngram_join, "LARGE_TILE", (48, 3, 6)[seed])
    monkeypatch.setattr(ngram_join, "BLOCK", (1024, 4, 1024)[seed])
    monkeypatch.setattr(ngram_join, "SHARED_FIRST", (4, 2, 4)[seed])
    monkeypatch.setattr(ngram_join, "KEY_BITS", (48, 48, 10)[seed])     # with few bits, elements share keys
    data = corpus(seed)
    data += [(1000, None, None, None), (1001, "", None, None), (1002, " \t\n", None, 1), (None, "lonely text of null id here", None, None)]
    data += [(None, data[3][1], None, None), (5, data[5][1], None, None), (5, data[5][1], None, None), (1003, "é " * 30_000, "x", None)]
    data += [(None, "one more null", None, None), (None, "one more null", None, None)]
    got = jaccard_components(spark.createDataFrame(data, SCHEMA).repartition(3))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert rows(got) == brute(data)


def test_chain_reaches_the_smallest(spark, rows):
    base = [f"v{i}" for i in range(60)]
    data = [(40 - k, " ".join([*base[2 * k :], *[f"x{i}" for i in range(2 * k)]]), None, None) for k in range(20)]
    got = rows(jaccard_components(spark.createDataFrame(data, SCHEMA)))
    assert got == brute(data) and {r[2] for r in got} == {21}


def test_empty(spark):
    assert jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shared_runs():
    rng = np.random.default_rng(3)
    for size in (1, 2, 3, 1000):
        a, b = rng.integers(0, 60, 200), rng.integers(0, 4, 200)
        order = np.lexsort((b, a))
        batches = [pa.RecordBatch.from_arrays([a[order][i : i + size], b[order][i : i + size]], ["element", "half"]) for i in range(0, 200, size)]
        got = [x for batch in shared_runs(iter(batches)) for x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        distinct = sorted(set(zip(a.tolist(), b.tolist())))
        assert got == [x for x in distinct if sum(y[0] == x[0] for y in distinct) > 1]


def test_tile_links():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 2, 40, 40, 300)]
    sets += [np.unique(np.concatenate([s[: len(s) * 9 // 10 + 1], rng.integers(0, 1 << 63, 2, dtype=np.uint64)])) for s in sets]
    want = [[100 * len(np.intersect1d(x, y)) >= 75 * len(np.union1d(x, y)) for y in sets] for x in sets]
    assert tile_links(sets, sets, 75).tolist() == want


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (40, 39)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)}
