import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skeinwork.llm.language_id import is_held_out
from skeinwork.llm.language_model import _gaps, _pack, _totals, _unpack, score_texts, words

SCHEMA = "doc_id long, text string, score string, block int"
K = 30.0


def brute(rows, order):
    """Interpolated probabilities, straight from dictionaries."""
    trains = [r[0] is None or zlib.crc32(str(r[0]).encode()) % 5 != 1 for r in rows]
    tokens = [[*words(r[1]), "end"] for r in rows]
    counts = [Counter() for _ in range(order)]
    contexts = Counter()
    for t, on in zip(tokens, trains):
        if on:
            marked = ["start", *t]
            contexts["start",] += 1
            for i in range(1, len(marked)):
                for n in range(1, order + 1):
                    gram = tuple(marked[max(0, i - n + 1) : i + 1])
                    if len(gram) == n:
                        counts[n - 1][gram] += 1
    total, vocabulary = sum(counts[0].values()), len(counts[0])
    for n in range(order - 1):
        contexts.update(counts[n])
    base = lambda w: (counts[0][w,] + 0.5) / (total + 0.5 * (vocabulary + 1))

    def p(context, w):
        if not context:
            return base(w)
        return (counts[len(context)][(*context, w)] + K * p(context[1:], w)) / (contexts[context] + K)

    out = []
    for r, t, on in zip(rows, tokens, trains):
        marked = ["start", *t]
        score = sum(math.log10(p(tuple(marked[max(0, i - order + 1) : i]), marked[i])) for i in range(1, len(marked)))
        out.append((r[0], on, len(t), sum(counts[0][w,] > 0 for w in t), total, sum(math.log10(base(w)) for w in t), score))
    return sorted(out, key=repr)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_brute_force(spark, order):
    text = "The cat sat on the mat. the Cat ran\tto the\x0bmat and the dog sat on the cat"
    data = [(i, " ".join(text.split(" ")[i % 5 : 4 + i % 11]), "x", i) for i in range(60)]
    data += [(61, None, None, None), (62, "", None, 1), (None, "the cat", None, 1), (6, "unseen words here", None, None), (6, "unseen words here", None, None), (70, "the cat sat " * 4000, None, 1)]
    df = spark.createDataFrame(data, SCHEMA)
    got = score_texts(df, ~is_held_out(F.col("doc_id"), rest=1), order=order, block_bytes=200, bucket_tokens=700)
    assert got.columns == ["doc_id", "trained", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    found = sorted((tuple(r) for r in got.collect()), key=repr)
    for a, b in zip(found, brute(data, order), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert score_texts(df, F.lit(True)).count() == 0
    one = score_texts(spark.createDataFrame([(1, "a", None, 1)], SCHEMA), F.lit(False)).collect()
    assert one[0]["train_tokens"] == 0 and one[0]["n_known"] == 0


def test_counts_beyond_32_bits(spark):
    """Totals of a corpus in which a word is more common than four bytes can count."""
    keys, large = np.array([5, 9, 1 << 63], np.uint64), [(1 << 33) + 1, 7, (1 << 60) + 3]
    sent = [(0, 1, b, bytearray(_gaps(keys)), bytearray(_pack(np.array(large, "<u8")))) for b in range(3)]
    requests = spark.createDataFrame(sent, "bucket int, n int, block long, keys binary, counts binary")
    for row in _totals(requests).collect():
        assert _unpack(row["totals"], "<u8").tolist() == [3 * c for c in large]
