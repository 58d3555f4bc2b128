import hashlib
import random
import re

import pytest

from skeinwork.llm import fill_in_middle as fim

SCHEMA = "doc_id long, text string, output string, form string, h1 int"
TEXTS = [
    "", "\n", "\n\n", "a", "a\n", "\na", "one\ntwo\nthree", "one\ntwo\nthree\n", "é\n日本\r\n\x85 x y\n\U0001f600", "has <P> in it\nx",
    "<S>", "x\n<M>", "<P\n>", "<\nS>", "a<\nP>b\n<", "< P>\n<<\n>>\n", "x\n" * 4000, "long line " * 9000, "same", "same",
]


def by_hand(doc_id, text, unit="line", seed=7, rate=100, spm_share=50, marks=fim.SENTINELS):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    n = len(units)
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in marks) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    p, s, m = marks
    if h4 % 100 < spm_share:
        return doc_id, n, "spm", len(prefix), len(middle), s + suffix + p + prefix + m + middle
    return doc_id, n, "psm", len(prefix), len(middle), p + prefix + s + suffix + m + middle


def some_rows():
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choices("ab é日\n\n<>PSM", k=rng.randrange(60))) for _ in range(400)] + [None]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "no id\nat all\n"), (None, None), (7, "again\nseven"), (7, "again\nseven")]


@pytest.mark.parametrize("how", [{}, {"unit": "char"}, {"rate": 40, "spm_share": 90, "seed": 1}, {"sentinels": ("<pre>", "<suffix>", "<mid>")}])
def test_against_brute_force(spark, rows, how):
    data = some_rows()
    docs = spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in data], SCHEMA).repartition(3)
    marks = how.get("sentinels", fim.SENTINELS)
    moved = fim.fill_in_middle(docs, **how)
    want = [by_hand(i, t, marks=marks, **{k: v for k, v in how.items() if k != "sentinels"}) for i, t in data]
    assert rows(moved) == sorted(want, key=repr)
    back = fim.restore_text(moved, sentinels=marks).select("doc_id", "restored")
    assert rows(back) == sorted(((i, t or "") for i, t in data), key=repr)
    at_once = fim.fill_in_middle(docs, restore=True, **how).select("doc_id", "restored")
    assert rows(at_once) == rows(back)
    forms = {r["form"] for r in moved.select("form").distinct().collect()}
    assert forms == set(fim.FORMS)


def test_blocks_and_runs_change_nothing(spark, rows, monkeypatch):
    import numpy as np
    import pyarrow as pa

    texts = pa.array([t or "" for _, t in some_rows()], pa.large_string())
    h = np.array([[int(hashlib.sha256(f"{i}:{k}".encode()).hexdigest()[:8], 16) for i in range(len(texts))] for k in range(4)])
    whole = fim._transformed(texts, h, [m.encode() for m in fim.SENTINELS], "line", 100, 50)
    monkeypatch.setattr(fim, "BLOCK", 7)
    blocks = fim._transformed(texts, h, [m.encode() for m in fim.SENTINELS], "line", 100, 50)
    assert [c.to_pylist() for c in whole] == [c.to_pylist() for c in blocks]
    runs = list(fim._runs(texts, 500))
    assert runs[0][0] == 0 and runs[-1][1] == len(texts) and all(a[1] == b[0] for a, b in zip(runs, runs[1:]))
    back = fim._rebuilt(whole[-1], np.array(whole[1].to_pylist(), object), [m.encode() for m in fim.SENTINELS])
    assert back.to_pylist() == texts.to_pylist()


def test_empty_nulls_and_wrong_sentinels(spark, rows):
    empty = spark.createDataFrame([], SCHEMA)
    moved = fim.fill_in_middle(empty)
    assert moved.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert fim.restore_text(moved).count() == 0
    odd = spark.createDataFrame([(None, "psm"), ("x", None), ("x", "plain")], "output string, form string")
    assert [r[0] for r in fim.restore_text(odd).select("restored").collect()] == [None, None, "x"]
    with pytest.raises(ValueError):
        fim.fill_in_middle(empty, sentinels=("<P>", "<P>", "<M>"))
    with pytest.raises(ValueError):
        fim.fill_in_middle(empty, sentinels=("a", "ab", "b"))


def test_a_very_long_text(spark):
    text = "été \n" * 2_000_000 + "end"
    docs = spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")
    moved = fim.restore_text(fim.fill_in_middle(docs)).collect()
    assert {r["doc_id"]: r["restored"] for r in moved} == {1: text, 2: "x"}
    assert tuple(moved[0])[:6] == by_hand(1, text)
