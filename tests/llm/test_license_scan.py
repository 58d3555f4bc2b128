import random
import re
from re import _constants as c
from re import _parser

import pytest

from skeinwork.llm.license_rules import BASE, KINDS, Rule, all_rules
from skeinwork.llm.license_scan import Scanner, license_summary, scan_licenses, words

SCHEMA = "doc_id long, text string, labels string, detections string, n_words int"


def example(tree, rng):
    """A text that the parsed pattern matches."""
    out = []
    for op, value in tree:
        if op is c.LITERAL:
            out.append(chr(value))
        elif op is c.NOT_LITERAL:
            out.append("x" if value != ord("x") else "y")
        elif op is c.IN:
            kind, what = rng.choice([v for v in value if v[0] is not c.NEGATE])
            if value[0][0] is c.NEGATE:
                out.append("w")
            else:
                out.append(chr(what) if kind is c.LITERAL else chr(rng.randint(*what)))
        elif op is c.MAX_REPEAT:
            low, high, inner = value
            out += [example(inner, rng) for _ in range(rng.randint(low, min(high, low + 2)))]
        elif op is c.BRANCH:
            out.append(example(rng.choice(value[1]), rng))
        elif op is c.SUBPATTERN:
            out.append(example(value[3], rng))
        else:
            raise AssertionError(op)
    return "".join(out)


def test_every_rule_is_found_through_its_keyword():
    rng = random.Random(1)
    rules = all_rules()
    assert len(rules) > 300 and len(set(rules)) == len(rules) and {r.kind for r in rules} == set(KINDS)
    for number, rule in enumerate(rules):
        scan = Scanner([rule])
        for _ in range(25):
            text = example(_parser.parse(rule.pattern), rng)
            assert rule.keyword in text.split(" "), (rule, text)
            n, found = scan(f"one two, {text.upper()}. end")
            assert n == 3 + len(text.split()) and found and found[0][0] == 0, (rule, text)
        assert "," not in rule.label


def by_hand(doc_id, text, rules):
    """All rules on every text, all pairs of detections."""
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or ""))
    line = " " + " ".join(found) + " "
    spans = []
    for k, rule in enumerate(rules):
        for m in re.finditer(f" (?:{rule.pattern})(?= )", line):
            a = line[: m.start()].count(" ")
            spans.append((k, a, a + m.group(0).count(" ")))

    def better(x, y):
        p, q = KINDS[rules[x[0]].kind][0], KINDS[rules[y[0]].kind][0]
        return (p, -(x[2] - x[1]), x[0]) < (q, -(y[2] - y[1]), y[0])

    kept = [y for y in spans if rules[y[0]].kind == "base" or not any(x[1] <= y[1] and y[2] <= x[2] and better(x, y) for x in spans)]
    base = [x for x in kept if rules[x[0]].kind == "base"]
    starts = [x[1] for x in base]
    names = lambda some: ",".join(sorted({rules[x[0]].label for x in some}))
    score = max((KINDS[rules[x[0]].kind][1] for x in kept), default=0.0)
    return doc_id, len(found), len(base), min(starts, default=None), max(starts, default=None), names(base), names(kept), score


def some_rows():
    rng = random.Random(2)
    rules = all_rules()
    plain = "the of mit license licence gnu version 2 3 0 cc by nc sa under apache été 日本 public domain , . - / \n".split(" ")
    texts = [
        None, "", " \n ", "...", "é", "Under the MIT-License", "under the mit license under the MIT license", "CC BY-NC 4.0.", "cc by ncx cc by nc",
        "Licensed under the Apache License, Version 2.0 (the License)", "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: BSD-3-Clause-Clear", "spdx-license-identifier: GPL-2.0-or-later", "undér the mit license", "a\x00mit\x7flicense",
        "gnu lesser general public license version 2.1", "Released under the MIT License. " * 3, "cc by nc sa 4 0", "cc-by-nc " * 3000, "plain words only",
    ]
    for _ in range(250):
        parts = [rng.choice(plain) for _ in range(rng.randrange(40))]
        parts += [example(_parser.parse(rng.choice(rules).pattern), rng) for _ in range(rng.randrange(4))]
        rng.shuffle(parts)
        texts.append(" ".join(parts))
    return list(enumerate(texts)) + [(None, "cc by nc"), (3, "cc by nc"), (3, "cc by nc")]


def test_against_brute_force(spark, rows):
    data, rules = some_rows(), all_rules()
    docs = spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in data], SCHEMA).repartition(3)
    got = license_summary(scan_licenses(docs))
    assert rows(got) == sorted((by_hand(i, t, rules) for i, t in data), key=repr)


def test_titles_inside_notices_are_suppressed():
    scan, rules = Scanner(all_rules()), all_rules()
    labels = lambda text: [(rules[r].label, rules[r].kind, a, b) for r, a, b in scan(text)[1]]
    assert labels("It is released under the MIT license, ok") == [("mit", "notice", 2, 7), ("mit", "base", 3, 7)]
    assert labels("gnu general public license version 3") == [("gpl-3", "title", 0, 6)]
    # the longer identifier and the shorter one begin alike
    assert labels("SPDX-License-Identifier: MIT-0") == [("mit-0", "tag", 0, 5)]
    # an overlap in part stays
    own = [Rule("a", "title", "x", "w x y"), Rule("b", "name", "y", "y z")]
    assert [own[r].label for r, _, _ in Scanner(own)("w x y z")[1]] == ["a", "b"]


def test_base_phrases_are_the_contract():
    assert [" ".join(w.decode() for w in words(p)) for _, p in BASE] == ["under the mit license", "apache license version 2", "cc by nc"]


@pytest.mark.parametrize("n", [0, 1])
def test_empty_table(spark, n):
    docs = spark.createDataFrame([(1, None, "x", "y", 2)][:n], SCHEMA)
    got = license_summary(scan_licenses(docs))
    assert [tuple(r) for r in got.collect()] == [(1, 0, 0, None, None, "", "", 0.0)][:n]
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
