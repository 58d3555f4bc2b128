import random

from pyspark.sql import functions as F

from skeinwork.llm.secrets import candidates, dictionary_trigrams, dictionary_words, featured, scan_secrets, transitions, weak_labels

SCHEMA = "doc_id long, text string, source string, value string, score int"


def corpus(n, seed=1):
    rng = random.Random(seed)
    common = ["house", "water", "garden", "window", "mountain", "internationalisation", "counterrevolutionaries"]
    rows = []
    for i in range(n):
        w = [rng.choice(common) for _ in range(30)]
        kind = i % 4
        if kind == 0:
            w[5:5] = ["token", "=", f'"{rng.getrandbits(160):040x}"']
        if kind == 1:
            w[7:7] = [str(rng.randrange(10**15, 10**16))]
        if kind == 2:
            w[9:9] = ["api_key", ":", "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16))]
        rows.append((i, " ".join(w), "src/app.cfg" if kind else "docs/test.md", "clash", 1))
    return rows


def test_candidates(spark, rows):
    data = [(1, 'a key="abcdefghijklmnop" b', "p", None, None), (2, None, None, None, None), (3, "", "p", None, None), (4, "short words only", "p", None, None),
            (5, "abcdefghijklmnopq,abcdefghijklmnopr", None, None, None), (None, "x\tabcdefghijklmnopq\ny", "p", None, 1), (6, "z" * 50_000, "p", None, None)]
    got = candidates(spark.createDataFrame(data, SCHEMA)).select("id", "word_no", "nth", "value", "before1", "after1", "path")
    assert rows(got) == sorted([
        (1, 1, 0, "abcdefghijklmnop", "a", "b", "p"), (5, 0, 0, "abcdefghijklmnopq", "", "", ""), (5, 0, 1, "abcdefghijklmnopr", "", "", ""),
        (None, 1, 0, "abcdefghijklmnopq", "x", "y", "p"), (6, 0, 0, "z" * 50_000, "", "", "p"),
    ], key=repr)


def test_features_by_hand(spark):
    df = spark.createDataFrame([(1, "my token = 'abcABC123+/xyzxyz' house house house house house", "a/b/x.env", None, None)], SCHEMA)
    r = featured(candidates(df), dictionary_trigrams(df)).first()
    assert (r["length"], r["digits"], r["capitals"], r["others"]) == (17, 3 / 17, 3 / 17, 2 / 17)
    assert r["changes"] == 4 / 16 and r["coverage"] == 0 and r["depth"] == 2
    assert (r["announced"], r["assigned"], r["quoted"], r["config_path"], r["test_path"]) == (1, 1, 1, 1, 0)


def test_held_out(spark):
    df = spark.createDataFrame(corpus(400), SCHEMA)
    got = scan_secrets(df, learn=F.col("doc_id") % 5 != 0)
    assert got.columns == ["doc_id", "word_no", "nth", "value", "score", "secret"]
    held = [r for r in got.collect() if r["doc_id"] % 5 == 0]
    right = [r["secret"] == (r["value"].startswith("AKIA") or len(r["value"]) == 40) for r in held]
    assert len(held) > 100 and sum(right) >= 0.98 * len(right)


def test_labels_may_come_from_elsewhere(spark):
    df = spark.createDataFrame(corpus(80), SCHEMA)
    by_hand = lambda rows: rows.withColumn("label", F.col("value").startswith("AKIA").cast("double"))
    got = scan_secrets(df, learn=F.lit(True), labels=by_hand).where("secret").collect()
    assert got and all(r["value"].startswith("AKIA") for r in got)


def test_next_to_observed_metrics(spark):
    """A session that has observed a write cannot be sent along with a forest."""
    from skeinwork.session import materialize_counted

    assert materialize_counted(spark.range(3), "three")[1] == 3
    df = spark.createDataFrame(corpus(80), SCHEMA)
    assert scan_secrets(df, learn=F.lit(True)).where("secret").count() > 0


def test_without_labels(spark):
    df = spark.createDataFrame(corpus(8), SCHEMA)
    assert {r["score"] for r in scan_secrets(df, learn=F.lit(False)).collect()} == {0.0}
    empty = spark.createDataFrame([], SCHEMA)
    assert scan_secrets(empty, learn=F.lit(True)).count() == 0


def test_plan_has_no_python(spark):
    plan = scan_secrets(spark.createDataFrame(corpus(40), SCHEMA), learn=F.lit(True))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def planted(n, seed=9):
    """Text, and the values in it that are secrets; some announcing words announce nothing, some odd values are none."""
    rng = random.Random(seed)
    common = ["house", "water", "garden", "window", "mountain", "internationalisation", "counterrevolutionaries", "token", "password"]
    mixed = lambda chars, k: "".join(rng.choices(chars, k=k))
    upper, alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"
    make = [
        lambda: f"{rng.getrandbits(160):040x}", lambda: "ghp_" + mixed(alnum, 36), lambda: "AKIA" + mixed(upper, 16),
        lambda: mixed(alnum, 4) + "." + mixed(alnum, 5) + "!" + mixed("0123456789", 3),
    ]
    rows = []
    for i in range(n):
        w, kind, secret = [rng.choice(common) for _ in range(25)], i % 7, None
        if kind < 4:
            secret = make[kind]()
            announced = [["token", "="], ["api_key:"], ["password", ":"], []][i % 4 if kind < 3 else rng.randrange(3)]
            w[6:6] = [*announced, rng.choice(['"%s"', "'%s',", "%s"]) % secret]
        elif kind == 4:
            w[6:6] = [str(rng.randrange(10**17, 10**18)), "the", "password", "internationalisation"]
        elif kind == 5:
            w[6:6] = ["token", "=", rng.choice(["counterrevolutionaries", "windowgarden"])]
        rows.append((i, " ".join(w), "src/app.cfg" if i % 2 else "docs/x.md", kind, secret))
    return rows


def test_a_format_without_labels_is_found(spark):
    """No label for AKIA keys nor for short passwords: they are found on held-out texts by what the others taught."""
    rows = planted(1400)
    df = spark.createDataFrame([(i, t, s, None, None) for i, t, s, _, _ in rows], SCHEMA)
    unseen = F.col("value").startswith("AKIA") | (F.length("value") < 16)
    labels = lambda found: weak_labels(found.where(~unseen | F.col("value").rlike("^[a-z]+$")))
    got = {(r["doc_id"], r["value"]): r["secret"] for r in scan_secrets(df, learn=F.col("doc_id") % 5 != 0, labels=labels).collect()}
    held = [r for r in rows if r[0] % 5 == 0]
    # kinds 2 and 3 are new to the forest; a value that nothing announces (AKIA at i % 4 = 3) is not asked for
    for kind in range(4):
        own = [r for r in held if r[3] == kind and (kind == 3 or r[0] % 4 != 3)]
        found = [got.get((r[0], r[4]), False) for r in own]
        assert len(own) >= 25 and sum(found) >= 0.9 * len(own), (kind, sum(found), len(own))
    secrets = {(r[0], r[4]) for r in held if r[4]}
    reported = [k for k, secret in got.items() if secret and k[0] % 5 == 0]
    assert sum(k in secrets for k in reported) >= 0.97 * len(reported)


def test_assigned_values_and_equal_ones(spark, rows):
    data = [
        (1, 'password = "Tr0ub4dor&3x" ok', None, None, None), (2, "api_key:'p.q!r@s#t', next", None, None, None), (3, 'secret="short"', None, None, None),
        (4, "abcdefghijklmnop;token=abcdefghijklmnop;x", None, None, None), (5, "the password is unknown_to_me now", None, None, None),
        (6, "token= abcdefghijklmnop.qrstuvwx", None, None, None), (7, "key = value_value", None, None, None),
    ]
    got = candidates(spark.createDataFrame(data, SCHEMA)).select("id", "word_no", "nth", "value", "before")
    assert rows(got) == [
        (1, 2, 0, "Tr0ub4dor&3x", '"'), (2, 0, 0, "p.q!r@s#t", "api_key:'"), (4, 0, 0, "abcdefghijklmnop", ""), (4, 0, 1, "token=abcdefghijklmnop", " ;"),
        (4, 0, 2, "abcdefghijklmnop;x", "abcdefghijklmnop;token="), (6, 1, 0, "abcdefghijklmnop", ""), (6, 1, 1, "abcdefghijklmnop.qrstuvwx", ""),
    ]


def test_features_against_python(spark):
    """Every numeric feature of every candidate, by plain Python."""
    import math
    import re
    from collections import Counter

    df = spark.createDataFrame([(i, t, s, None, None) for i, t, s, _, _ in planted(140)], SCHEMA)
    words = dictionary_words(df)
    held = Counter(w for r in df.collect() for w in re.split(r"[^a-zäöü]+", r["text"].lower()) if len(w) >= 3)
    held = {w: n for w, n in held.items() if n >= 5}
    assert {r["word"]: r["n"] for r in words.collect()} == held
    grams = {w[i : i + 3] for w in held for i in range(len(w) - 2)}
    pairs, first = Counter(), Counter()
    for w, n in held.items():
        for i in range(len(w) - 1):
            pairs[w[i : i + 2]] += n
            first[w[i]] += n
    cost = {p: -math.log10((n + 0.5) / (first[p[0]] + 0.5 * 64)) for p, n in pairs.items()}
    kind = lambda c: 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c in "+/_=-" else None
    for r in featured(candidates(df), dictionary_trigrams(df, words=words), words, transitions(words)).collect():
        v = r["value"]
        letters = re.sub("[^a-z]+", "", v.lower())
        own = [letters[i : i + 3] for i in range(len(letters) - 2)]
        spelled = re.sub("[^a-z0]", "_", re.sub("[0-9]", "0", v.lower()))
        costs = [cost.get(spelled[i : i + 2], 6.0) for i in range(len(v) - 1)]
        parts = [p.lower() for p in re.findall("[A-Z]?[a-z]+|[A-Z]+", v)]
        changes = sum(kind(a) is not None and kind(a) != kind(b) for a, b in zip(v, v[1:]))
        want = {
            "length": len(v), "digits": sum(c.isdigit() for c in v) / len(v), "capitals": sum(c.isupper() for c in v) / len(v),
            "others": sum(c in "+/_=-" for c in v) / len(v), "coverage": sum(g in grams for g in own) / max(1, len(own)),
            "known_words": sum(len(p) for p in parts if p in held) / len(v), "surprise": sum(costs) / len(costs), "changes": changes / (len(v) - 1),
        }
        for name, x in want.items():
            assert abs(r[name] - x) < 1e-9, (name, v, r[name], x)
