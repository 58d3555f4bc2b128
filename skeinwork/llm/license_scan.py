"""Licence scan by ordered signature rules.

A text becomes its words: A to Z in lower case, everything else in ASCII that is
no digit or letter a blank, one blank between two words. Every rule has a keyword;
only rules whose keyword is a word of the text run their regular expression over
the words (`license_rules.py`). A detection is a run of words with a label, a
priority and a confidence.

Detections overlap: a title lies inside a notice, a name inside a title. One is
suppressed when its words lie inside those of another with a better priority, or
of a longer one with the same priority, or of the same run from an earlier rule.
Detections that overlap only in part stay. The base phrases are the best
priority and are never suppressed.

Defined results: a null or empty text, or one without words, has no words,
no detections, empty label strings and score 0. Every place of a base phrase
counts, also repeated ones. A very long text is scanned whole; what is held for it
grows with its words and detections. Repeated rows give repeated rows; an empty
table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.license_rules import KINDS, Rule, all_rules

_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
DETECTION = "struct<label: string, kind: string, first_word: bigint, last_word: bigint, score: double>"


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8."""
    return (text or "").encode().translate(_TO_WORDS).split()


def surviving(first: np.ndarray, stop: np.ndarray, priority: np.ndarray, rule: np.ndarray) -> np.ndarray:
    """Which runs of words [first, stop) are not suppressed by another one; see the module's text."""
    keep = np.ones(len(first), bool)
    for level in np.unique(priority):
        here = np.flatnonzero(priority <= level)
        order = here[np.lexsort((rule[here], priority[here], -stop[here], first[here]))]
        # all before in this order begin no later; one of them covers a run when its end is no earlier
        reach = np.maximum.accumulate(stop[order])
        covered = np.zeros(len(order), bool)
        covered[1:] = reach[:-1] >= stop[order][1:]
        keep[order[covered & (priority[order] == level)]] = False
    return keep


class Scanner:
    """Compiled rules by keyword."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        self.by_keyword: dict[bytes, list[int]] = {}
        for number, rule in enumerate(rules):
            self.by_keyword.setdefault(rule.keyword.encode(), []).append(number)
        self.keywords = frozenset(self.by_keyword)
        # a match begins with the blank before its first word
        self.find = [re.compile(f" (?:{r.pattern})(?= )".encode()).finditer for r in rules]
        self.priority = np.array([KINDS[r.kind][0] for r in rules])
        self.base = np.array([r.kind == "base" for r in rules])

    def __call__(self, text: str | None) -> tuple[int, list[tuple[int, int, int]]]:
        """Number of words, and (rule, first word, word after the last) of what stays, by place."""
        found = words(text)
        near = self.keywords.intersection(found)
        if not near:
            return len(found), []
        line = b" " + b" ".join(found) + b" "
        spans = [(n, m.start(), m.end()) for k in near for n in self.by_keyword[k] for m in self.find[n](line)]
        if not spans:
            return len(found), []
        rule, begin, end = np.array(spans, np.int64).T
        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        first, stop = np.searchsorted(blanks, begin), np.searchsorted(blanks, end)
        keep = surviving(first, stop, self.priority[rule], rule) | self.base[rule]
        return len(found), sorted(zip(rule[keep].tolist(), first[keep].tolist(), stop[keep].tolist()), key=lambda d: (d[1], d[2], d[0]))


def scan_licenses(docs: DataFrame, rules: list[Rule] | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, `n_words`, and `detections` in the order of their places.

    A detection has `label`, `kind`, `first_word` and `last_word` (from 0) and
    `score`, the confidence of its kind.
    """
    rules = all_rules() if rules is None else rules
    kind = docs.schema[id].dataType
    detection = pa.list_(pa.struct([
        ("label", pa.string()), ("kind", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64()),
    ]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(rules)
        for batch in batches:
            counts, rows = [], []
            for value in batch.column(1):
                n, found = scan(value.as_py())
                counts.append(n)
                rows.append([
                    {"label": rules[r].label, "kind": rules[r].kind, "first_word": a, "last_word": b - 1, "score": KINDS[rules[r].kind][1]}
                    for r, a, b in found
                ])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(rows, detection)], ["id", "n_words", "detections"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {kind.simpleString()}, n_words long, detections array<{DETECTION}>").withColumnRenamed("id", id)


def license_summary(scanned: DataFrame, detections: str = "detections") -> DataFrame:
    """`detections` replaced by figures of each row: places and ends of the base phrases, label strings, best score."""
    found = F.col(detections)
    base = F.filter(found, lambda d: d["kind"] == "base")
    joined = lambda some: F.array_join(F.array_sort(F.array_distinct(F.transform(some, lambda d: d["label"]))), ",")
    starts = F.transform(base, lambda d: d["first_word"])
    return scanned.withColumns({
        "n_base": F.size(base).cast("bigint"), "first_word": F.array_min(starts), "last_word": F.array_max(starts),
        "base_labels": joined(base), "labels": joined(found),
        "score": F.coalesce(F.array_max(F.transform(found, lambda d: d["score"])), F.lit(0.0)),
    }).drop(detections)
