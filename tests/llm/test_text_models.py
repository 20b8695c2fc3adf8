"""Language, licences, quality and language model against plain versions."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bourselake.llm import common, license_rules, op2_language_id, op4_licenses, op8_ppm, op9_quality, ppm
from tests.llm.fixtures import FOX, LONG, awkward, documents, needs_tables

SMALL = "/root/testdata/sf0.01"


@needs_tables
def test_held_out_languages_are_told(spark):
    docs = common.documents(spark, SMALL)
    found = op2_language_id.query(spark, docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.filter("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert np.mean([r["rejected"] for r in held]) < 0.02
    assert all(0 <= r["score"] <= 1 for r in held)


def test_no_letter_is_undetermined_and_ties_go_to_the_larger_language(spark):
    assert op2_language_id.Classifier({"en": b"the quick brown fox"}).predict("12 - 3") == ("und", 0.0, True)
    for signs in ("½", "² ①", "Ⅳ ⅷ", "١٢", "_"):
        assert op2_language_id.Classifier({"en": b"the quick brown fox"}).predict(signs) == ("und", 0.0, True)
    assert op2_language_id.letters_only("ß²x 一½Ǆ") == "ß x 一 ǆ".encode()
    both = op2_language_id.Classifier({"xx": b"aaaaaaaaaaaa", "yy": b"aaaaaaaaaaaa"})
    assert both.predict("some words here")[0] == "xx"
    assert both.predict("some words here")[2]
    found = {r["doc_id"]: r for r in op2_language_id.query(spark, awkward(spark)).collect()}
    assert found[3]["lang_pred"] == "und" and found[4]["lang_pred"] == "und"
    assert found[9]["lang_pred"] in {"en", "de", "fr"}


def test_dictionaries_see_training_rows_only(spark):
    texts = [f"alpha beta {'gamma' if zlib.crc32(str(i).encode()) % 3 == 1 else 'delta'}" for i in range(60)]
    content = op2_language_id.fit(documents(spark, texts))
    assert b"delta" in content["en"] and b"gamma" not in content["en"]


PHRASES = {
    "gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit",
}


def plain_licences(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in PHRASES.items():
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    starts = [p for p, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


LICENCES = [
    "Released under the MIT License.", "mit-license mit license MIT LICENSE",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0. cc by cc by", "Apache License, Version 2.0; apache_license", "",
    "GNU Lesser General Public License 2.1 or later", "All rights reserved.", "ñmit license é apache license",
    "SPDX-License-Identifier: BSD-3-Clause", FOX, LONG, "gnu general public license " * 300,
]


def test_licences_equal_a_plain_scan(spark):
    found = op4_licenses.query(spark, documents(spark, LICENCES)).collect()
    for row in found:
        text = LICENCES[row["doc_id"]]
        assert tuple(row[1:6]) == plain_licences(text), text
        assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(","))
        assert row["labels"] == ",".join(sorted(set(row["labels"].split(","))))
        assert 0 <= row["score"] <= 1
    labels = {r["doc_id"]: r["labels"] for r in found}
    assert labels[0] == "mit" and labels[2] == "gpl,gpl-3.0" and labels[4] == "apache,apache-2.0"
    assert labels[3] == "cc-by,cc-by-nc" and labels[6] == "lgpl-2.1" and labels[7] == "proprietary"
    assert labels[9] == "bsd-3-clause" and labels[10] == ""


def test_every_rule_has_its_keyword_and_contained_intervals_are_suppressed():
    rules = license_rules.build()
    assert len(rules) > 250
    assert [r.priority for r in rules] == sorted(r.priority for r in rules)
    scanner = op4_licenses.Scanner()
    _, _, found = scanner.scan("licensed under the terms of the Apache License, Version 2.0")
    assert [(d.start, d.end, d.label) for d in found] == [(0, 11, "apache-2.0")]
    # The prefilter loses nothing: running all rules on all texts finds the same.
    for text in LICENCES:
        joined = b" " + b" ".join(op4_licenses.words_of(text)) + b" "
        everything = scanner._detections(joined, set(scanner.by_keyword))
        assert everything == scanner.scan(text)[2]


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("GNU General Public License", "gpl"), ("Apache License", "apache"), ("the GPL.", "gpl"),
        ("GNU Lesser General Public License", "lgpl"), ("Mozilla Public License", "mpl"),
        ("Eclipse Public License", "epl"), ("licensed under the GPL", "gpl"), ("GPLv3+", "gpl-3.0"),
        ("GNU AGPL v3", "agpl-3.0"), ("Boost Software License", "boost"), ("MPL 2.0", "mpl-2.0"),
        ("Boost Software License, Version 1.0", "boost-1.0"), ("CC BY-SA 4.0", "cc-by-sa"),
        ("GNU Library General Public License version 2", "lgpl-2.0"), ("European Union Public Licence", "eupl"),
        ("Common Development and Distribution License", "cddl"), ("CC0", "cc0"), ("CC0 1.0", "cc0-1.0"),
        ("Eclipse Public License v2.0 or later", "epl-2.0"), ("nothing of the kind", ""),
    ],
)
def test_a_version_is_named_only_where_the_text_has_it(text, labels):
    assert ",".join(d.label for d in op4_licenses.Scanner().scan(text)[2]) == labels


def test_every_written_notice_is_found_through_its_keyword():
    """Notices without alternatives read as they are written."""
    scanner, read = op4_licenses.Scanner(), 0
    for label, _, words in license_rules.PASSAGES:
        if not re.search(r"[(|?.\[\\]", words):
            read += 1
            assert label in {d.label for d in scanner.scan(f"x {words} x")[2]}, (label, words)
    assert read > 60


@needs_tables
def test_held_out_quality(spark):
    docs = common.documents(spark, SMALL)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    found = op9_quality.query(spark, docs, labels).join(labels, "doc_id").filter("held_out").collect()
    good = [r["score"] for r in found if r["quality"] == 1]
    bad = [r["score"] for r in found if r["quality"] == 0]
    ahead = np.mean([g > b for g in good for b in bad])
    assert ahead > 0.95
    # What the scores themselves promise, less three standard deviations of so few rows.
    scores = np.array(good + bad)
    promised = scores[scores >= op9_quality.ACCEPT].sum() / scores.sum()
    spread = np.sqrt(promised * (1 - promised) / len(good))
    accepted = np.mean([s >= op9_quality.ACCEPT for s in good])
    assert accepted > promised - 3 * spread and accepted > 0.9
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in found)


@needs_tables
@pytest.mark.parametrize("sample", [op9_quality.SAMPLE, 600])
def test_scores_are_calibrated_whether_the_sample_is_balanced_or_not(spark, sample):
    """All labelled rows are in the larger sample, and as many of each class in the smaller."""
    docs = common.documents(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = op9_quality.fit(spark, docs, labels, sample=sample)
    held = docs.join(labels.filter("quality is not null"), "doc_id").filter(common.id_remainder(4) == 2)
    found = held.select("quality", "text").collect()
    scores = np.array([model.score(r["text"]) for r in found])
    good = np.array([r["quality"] == 1 for r in found])
    assert abs(scores.mean() - good.mean()) < 0.02
    assert np.mean(scores[~good] < op9_quality.ACCEPT) > 0.9
    assert np.mean(scores[good] >= op9_quality.ACCEPT) > 0.9


def test_class_counts_equal_a_plain_count(spark):
    rows = spark.createDataFrame([("abab", 1), ("abc", 0), ("", 1), (None, 0)], "text string, label int")
    found = {r["feature"]: (r["with_0"], r["with_1"]) for r in op9_quality.class_counts(rows).collect()}
    assert found[-1] == (2, 2)
    assert found[ord("a") << 8 | ord("b")] == (1, 1)
    assert found[ord("b") << 8 | ord("a")] == (0, 1)


def test_dual_descent_reaches_the_best_objective():
    """Against many steps of plain subgradient descent on the primal."""
    draw = np.random.default_rng(2)
    x = draw.normal(size=(60, 5))
    y = np.where(x @ np.array([1, -2, 0.5, 0, 0]) + draw.normal(size=60) * 0.3 > 0, 1.0, -1.0)
    rows = [(np.arange(5), r) for r in x]
    weights, bias = op9_quality.dual_descent(rows, y, 200, 1.0)
    share = np.where(y > 0, np.mean(y > 0), np.mean(y < 0))
    cost = 0.5 / share

    def objective(w):
        return 0.5 * w @ w + (cost * np.maximum(0, 1 - y * (x @ w[:5] + w[5]))).sum()

    w, best = np.zeros(6), np.inf
    for step in range(1, 20_000):
        active = y * (x @ w[:5] + w[5]) < 1
        pull = (cost * y * active) @ np.hstack([x, np.ones((60, 1))])
        w = w - (w - pull) / step
        best = min(best, objective(w))
    assert objective(np.append(weights[:5], bias)) <= best * 1.001 + 1e-9


def plain_ppm(texts, training, order=3):
    tries = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]

    def framed(t):
        return b"\xff" * order + t.encode() + b"\xff"

    for t in training:
        f = framed(t)
        for i in range(order, len(f)):
            for k in range(order + 1):
                tries[k][f[i - k : i]][f[i]] += 1
    scores = []
    for t in texts:
        f, score = framed(t), 0.0
        for i in range(order, len(f)):
            excluded = set()
            for k in range(order, -1, -1):
                seen = {s: n for s, n in tries[k].get(f[i - k : i], {}).items() if s not in excluded}
                if not seen:
                    continue
                total, kinds = sum(seen.values()), len(seen)
                if f[i] in seen:
                    score += math.log10(seen[f[i]] / (total + kinds))
                    break
                score += math.log10(kinds / (total + kinds))
                excluded |= set(seen)
            else:
                score -= math.log10(256 - len(excluded))
        scores.append(score)
    return scores


PPM_TEXTS = [FOX, FOX[:30] + " cat", "", "a", "abracadabra abra", "Größe 漢字", "x y z x y z q"] * 6 + [LONG[:3000]]


@pytest.mark.parametrize("order", [2, 3, 5])
def test_ppm_equals_a_plain_trie(spark, order):
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(PPM_TEXTS))]
    assert any(held)
    train = [t for t, h in zip(PPM_TEXTS, held, strict=True) if not h]
    found = op8_ppm.language_model(spark, documents(spark, PPM_TEXTS), order).orderBy("doc_id").collect()
    assert [r["held_out"] for r in found] == held
    assert [r["score"] for r in found] == pytest.approx(plain_ppm(PPM_TEXTS, train, order), abs=1e-9)
    counts = collections.Counter()
    for t in train:
        counts.update([*t.encode().lower().split(), None])
    total, kinds = sum(counts.values()), len(counts)
    for row, text in zip(found, PPM_TEXTS, strict=True):
        tokens = [*text.encode().lower().split(), None]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens)
        assert row["base_score"] == pytest.approx(base, abs=1e-9)
        assert (row["n_tokens"], row["train_tokens"]) == (len(tokens), total)
        assert row["n_known"] == sum(counts[w] > 0 for w in tokens)


def test_symbol_probabilities_sum_to_one():
    texts = ["abracadabra", "abc abd", "zz"]
    codes, counts = np.unique(np.concatenate([ppm.grams(t.encode(), 3) for t in texts]), return_counts=True)
    trie = list(zip((3, 2, 1, 0), ppm.levels(codes, counts, 3, 0), strict=True))
    for context in (b"abr", b"zzz", b"\xff\xffa", b" ab"):
        wanted = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)])
        assert (10 ** ppm.log_probabilities(wanted, trie)).sum() == pytest.approx(1)


def test_without_training_rows(spark):
    only = documents(spark, ["x"]).withColumn("doc_id", F.lit(_held_out_id()).cast("bigint"))
    row = op8_ppm.query(spark, only).first()
    assert (row["train_tokens"], row["n_known"], row["base_score"]) == (0, 0, 0.0)
    assert row["score"] == pytest.approx(-2 * math.log10(256))


def _held_out_id():
    return next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
