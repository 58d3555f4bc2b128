import hashlib
import math
import random

import numpy as np
import pytest

from skeinwork.llm import clustering as cl

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, label int"


def by_hand(rows, components, scale, k, rounds, seed):
    """Plain loops over Python's whole numbers."""
    vectors = []
    for i, v in rows:
        if v is None or len(v) != components or any(x is None or math.isnan(x) or math.isinf(x) for x in v):
            continue
        vectors.append((i, [max(-cl.LARGEST, min(cl.LARGEST, math.floor(scale * float(np.float32(x))))) for x in v]))
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(vectors, key=key)[:k]]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, v in vectors:
            members.setdefault(place(v)[1], []).append(v)
        for n, some in members.items():
            centroids[n] = [sum(x) // len(some) for x in zip(*some)]
    found = [(i, *place(v)) for i, v in vectors]
    own = {n: sum(d for _, d, m in found if m == n) for n in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    total = sum(own.values())
    fits = lambda x: x if x < 1 << 63 else None
    return [(i, n, d, fits(own[n]), fits(total), sha[n]) for i, d, n in found]


def some_vectors(width=6, n=300):
    rng = random.Random(4)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [rng.choice([-1, 0, 1]) + rng.gauss(0, 0.1) for _ in range(width)]) for i in range(n)]
    rows += [(1000 + i, [0.5] * width) for i in range(80)] + [(7, rows[7][1]), (7, [0.25] * width), (None, [0.1] * width), (None, None)]
    rows += [(2000, []), (2001, [0.0] * (width - 1)), (2002, [0.0] * (width + 1)), (2003, [None] + [0.0] * (width - 1))]
    rows += [(2004, [nan] + [0.0] * (width - 1)), (2005, [0.0] * (width - 1) + [inf]), (2006, [-inf] * width), (2007, [-0.001] * width)]
    return rows


@pytest.mark.parametrize("how", [
    {"k": 5, "rounds": 3}, {"k": 1, "rounds": 1}, {"k": 40, "rounds": 2, "seed": 9}, {"k": 3, "rounds": 0, "scale": 1}, {"k": 1000, "rounds": 2},
])
def test_against_plain_loops(spark, rows, how):
    data = some_vectors()
    df = spark.createDataFrame([(i, v, "clash", "clash", 1) for i, v in data], SCHEMA).repartition(5)
    settings = {"components": 6, "scale": 64, "k": 5, "rounds": 3, "seed": 1} | how
    assert rows(cl.cluster_vectors(df, **settings)) == sorted(by_hand(data, **settings), key=repr)


def test_huge_components(spark, rows):
    data = [(i, [x, -x]) for i, x in enumerate([3.4e38, 1e30, 2.0**40, 1e5, 0.0, 1.0, -3.4e38])]
    df = spark.createDataFrame([(i, v, "", "", 1) for i, v in data], SCHEMA)
    settings = {"components": 2, "scale": 64, "k": 2, "rounds": 2, "seed": 1}
    assert rows(cl.cluster_vectors(df, **settings)) == sorted(by_hand(data, **settings), key=repr)


@pytest.mark.parametrize("data", [[], [(1, None), (2, [])]])
def test_nothing_to_cluster(spark, data):
    got = cl.cluster_vectors(spark.createDataFrame([(i, v, "", "", 1) for i, v in data], SCHEMA))
    assert got.count() == 0 and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_tables_give_the_distances():
    rng = np.random.default_rng(0)
    centroids = rng.integers(-70, 70, (7, 5))
    centroids[3] = centroids[1]
    for vectors in (rng.integers(-70, 70, (500, 5)), rng.integers(-cl.LARGEST, cl.LARGEST, (50, 5))):
        direct = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        cluster, distance = cl.nearest(vectors, centroids)
        assert (cluster == direct.argmin(axis=1)).all() and (distance == direct.min(axis=1)).all() and not (cluster == 3).any()
