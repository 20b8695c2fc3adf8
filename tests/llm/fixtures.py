"""Documents with every awkward case, and the given tables where they exist."""

from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")

# Names that operators use themselves, with nulls: they have to pass through untouched.
KIND = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "_row string, fingerprint string, _size string, target string, _maybe string"
)
FOX = "The quick brown fox jumps over the lazy dog near the old river bank at dawn"
LONG = " ".join(f"word{i % 7919} and more" for i in range(12_000))


def awkward_rows():
    extra = ("r", None, "s", "t", None)
    rows = [
        (1, FOX, "en", "a", len(FOX)),
        (2, FOX.upper(), "en", "a", len(FOX)),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, LONG, "en", "b", len(LONG)),
        (6, "word", None, "c", 4),
        (7, FOX + " again", "en", "c", None),
        (7, FOX + " again", "en", "c", None),
        (8, " \t\n ", "de", None, 4),
        (9, "Größe ÄÖÜ 漢字 😀 naïve", "de", "d", 20),
        (None, "no id here", "en", "d", 10),
        (None, None, None, None, None),
        (-5, "123 +++ ---", "fr", "", 11),
    ]
    return [(*r, *extra) for r in rows]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), KIND).repartition(3)


def empty(spark):
    return spark.createDataFrame([], KIND)


def documents(spark, texts, source="s", lang="en"):
    rows = [(i, t, lang, source, len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"
    ).repartition(4)
