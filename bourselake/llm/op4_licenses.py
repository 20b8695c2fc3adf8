"""Licence scan by ordered signature rules.

A text becomes its words in lower case. A rule's expression runs only on texts that
have the rule's keyword, so nearly all texts cost one pass over their words. Where
detections overlap, the rule of higher priority stands, and what lies within
its interval is suppressed. Base phrases are found apart from the rules and always stay.

Everything happens within a document, in the scan, without a shuffle.

Defined cases: a null text is empty: no words, counts 0, positions null, labels empty
strings, score 0. Equal rows give equal results; no rows give no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.llm import license_rules
from bourselake.llm.common import bound_batches

#: ASCII other than letters and digits separates words; A-Z is lower-cased.
WORD_BYTES = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower()
)


class Detection(NamedTuple):
    """Words [start, end) that a rule recognised."""

    start: int
    end: int
    label: str
    rule: str
    score: float


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


class Scanner:
    def __init__(self):
        self.by_keyword: dict[bytes, list] = defaultdict(list)
        for order, rule in enumerate(license_rules.build()):
            self.by_keyword[rule.keyword.encode()].append((order, rule))
        self.base = [(f" {p} ".encode(), label) for p, label in license_rules.BASE]
        firsts = [phrase.split()[0] for phrase, _ in self.base]
        self.keywords = frozenset(self.by_keyword).union(firsts)

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, str]], list[Detection]]:
        """Number of words, base places with their labels, and the rules' detections."""
        words = words_of(text)
        there = self.keywords.intersection(words)
        if not there:
            return len(words), [], []
        joined = b" " + b" ".join(words) + b" "
        return len(words), self._base_places(joined), self._detections(joined, there)

    def _base_places(self, joined: bytes) -> list[tuple[int, str]]:
        places = []
        for phrase, label in self.base:
            at = joined.find(phrase)
            while at >= 0:
                places.append((joined.count(b" ", 0, at), label))
                at = joined.find(phrase, at + 1)
        return sorted(places)

    def _detections(self, joined: bytes, there: set[bytes]) -> list[Detection]:
        spoken = joined.decode()
        rules = sorted(
            (entry for keyword in there for entry in self.by_keyword.get(keyword, ())),
            key=lambda entry: entry[0],
        )
        found: list[tuple[int, int, int, license_rules.Rule]] = []
        for order, rule in rules:
            for match in rule.pattern.finditer(spoken):
                found.append((rule.priority, match.start() - match.end(), order, rule, match.span()))
        # By priority, then the longer interval, then the order of the rules.
        found.sort(key=lambda f: f[:3])
        kept: list[Detection] = []
        spans: list[tuple[int, int]] = []
        for *_, rule, (start, end) in found:
            if any(a <= start and end <= b for a, b in spans):
                continue
            spans.append((start, end))
            first = spoken.count(" ", 0, start) - 1
            last = first + spoken.count(" ", start, end) + 1
            kept.append(Detection(first, last, rule.label, rule.name, rule.score))
        return sorted(kept)


KIND = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, detections "
    "array<struct<start:int,end:int,label:string,rule:string,score:double>>"
)


def scan_column():
    """A column function: text to counts, positions, labels and detections."""

    @F.pandas_udf(KIND)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner()
        names = [field.split()[0] for field in KIND.split(", ")[:8]]
        for texts in batches:
            rows = []
            for text in texts:
                n_words, base, found = scanner.scan(text)
                base_labels = {label for _, label in base}
                score = max([1.0 if base else 0.0, *(d.score for d in found)])
                rows.append(
                    (
                        n_words,
                        len(base),
                        min((p for p, _ in base), default=None),
                        max((p for p, _ in base), default=None),
                        ",".join(sorted(base_labels)),
                        ",".join(sorted(base_labels.union(d.label for d in found))),
                        score,
                        [tuple(d) for d in found],
                    )
                )
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    return scanned


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    bound_batches(spark)
    return docs.select("doc_id", scan_column()("text").alias("s")).select("doc_id", "s.*")
