"""Nulls, empty and very long texts, ties, repeated rows, clashing names, empty tables."""

import pytest

import corpus_pipeline
from bourselake.llm import (
    op1_simhash,
    op2_language_id,
    op3_mixing,
    op4_licenses,
    op5_minhash,
    op6_pii,
    op7_exact_dedup,
    op8_ppm,
    op9_quality,
    op10_packing,
    op11_merkle,
    op12_signature_trees,
    op13_orchard,
)
from tests.llm.fixtures import awkward, awkward_rows, empty

MODULES = [
    op1_simhash, op2_language_id, op3_mixing, op4_licenses, op5_minhash, op6_pii,
    op7_exact_dedup, op8_ppm, op10_packing, op11_merkle, op12_signature_trees,
]


def labels(spark):
    rows = [(1, 1), (2, 0), (3, None), (None, 1), (7, 1), (7, 0), (99, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int")


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=lambda i: (i is None, i or 0))


WANTED = sorted((r[0] for r in awkward_rows()), key=lambda i: (i is None, i or 0))


@pytest.mark.parametrize("module", MODULES, ids=lambda m: m.__name__.rpartition(".")[2])
def test_every_row_has_a_result_and_no_rows_have_none(spark, module):
    found = module.query(spark, awkward(spark)).collect()
    if module is op10_packing:
        found = [r for r in found if r["piece"] == 0]
    assert ids(found) == WANTED
    none = module.query(spark, empty(spark))
    assert none.collect() == []


def test_quality_on_awkward_rows(spark):
    found = op9_quality.query(spark, awkward(spark), labels(spark)).collect()
    assert ids(found) == WANTED
    assert all(0 <= r["score"] <= 1 for r in found)
    assert op9_quality.query(spark, empty(spark), labels(spark)).collect() == []
    nothing = labels(spark).limit(0)
    untaught = op9_quality.query(spark, awkward(spark), nothing).collect()
    assert {r["score"] for r in untaught} == {0.5}


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_keep_columns_whatever_their_names(spark, stage):
    docs = awkward(spark)
    name, function = stage
    found = function(spark, docs, "")
    assert found.columns == docs.columns
    whole = {tuple(r) for r in docs.collect()}
    assert {tuple(r) for r in found.collect()} <= whole
    assert function(spark, empty(spark), "").collect() == []


def test_stage_decisions_on_awkward_rows(spark):
    docs = awkward(spark)
    stages = dict(corpus_pipeline.STAGES)
    told = stages["language_id"](spark, docs, "").collect()
    assert not any(r["text"] is None or not r["text"].strip() for r in told)
    unique = stages["exact_dedup"](spark, docs, "").collect()
    # Lower-casing joins 1 and 2; the repeated row stays once; the empty texts are one.
    assert ids(unique) == [-5, 2, 4, 5, 6, 7, 8, 9, None]
    near = stages["near_dedup"](spark, docs, "").collect()
    assert 1 in ids(near) and 2 not in ids(near)
    mixed = stages["mixing"](spark, docs, "").collect()
    assert all(r["text"] and r["text"].strip() for r in mixed)


def test_packing_takes_clashing_column_names(spark):
    pack = dict(corpus_pipeline.STAGES)["packing"]
    found = pack(spark, awkward(spark), "").filter("piece = 0").collect()
    assert ids(found) == WANTED
    assert pack(spark, empty(spark), "").collect() == []


def test_vectors_on_awkward_rows(spark):
    nan, far = float("nan"), float("inf")
    rows = [
        (3, [0.5] * 20, 1, "x"), (1, [0.25] * 20, None, "x"), (1, [0.25] * 20, None, "x"),
        (2, None, 1, "x"), (4, [nan] * 20, 1, "x"), (5, [0.1] * 19 + [None], 1, "x"),
        (6, [far] * 20, 1, "x"), (7, [], 1, "x"), (8, [1.0], 1, "x"), (None, [1e30] * 20, 2, "x"),
        (9, [-0.001] * 20, 1, None),
    ]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, part string")
    found = op13_orchard.query(spark, table).collect()
    assert ids([{"doc_id": r["vec_id"]} for r in found]) == [1, 1, 3, 9, None]
    assert len({r["codebooks_sha256"] for r in found}) == 1
    assert all(r["error"] == 0 and len(r["code"]) == 32 for r in found)
    assert op13_orchard.query(spark, table.limit(0)).collect() == []
