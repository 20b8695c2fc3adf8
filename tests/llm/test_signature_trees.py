"""The Jaccard join against brute force over all pairs."""

import random
from itertools import combinations

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bourselake.llm import common, op12_signature_trees
from tests.llm.fixtures import SF, documents, needs_tables
from tests.llm.test_dedup import plain_components


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def plain_classes(texts):
    sets = [plain_set(t) for t in texts]
    links = [
        (a, b)
        for a, b in combinations(range(len(sets)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    ]
    parts = plain_components(links, range(len(sets)))
    return {(i, len(s), parts[i]) for i, s in enumerate(sets)}, links


def changed(draw, words, n):
    words = list(words)
    for at in draw.sample(range(len(words)), n):
        words[at] = f"x{draw.randrange(10**6)}"
    return words


def copies():
    """Copies above and below the limit, a template with own endings, short sets of all sizes."""
    draw = random.Random(1)
    texts = ["", "  ", "one two", "One  two", "one two three", "\u00a0"]
    base = [f"w{draw.randrange(5000)}" for _ in range(400)]
    texts += [" ".join(changed(draw, base, draw.choice([3, 6, 10]))) for _ in range(120)]
    same = [f"w{draw.randrange(5000)}" for _ in range(300)]
    texts += [" ".join(same + [f"u{draw.randrange(10**6)}" for _ in range(40)]) for _ in range(50)]
    for n in (5, 9, 10, 12, 20, 40, 2000):
        for _ in range(4):
            own = [f"w{draw.randrange(50000)}" for _ in range(n)]
            texts += [" ".join(own), " ".join(own + ["extra"]), " ".join(own[:-1]), " ".join(changed(draw, own, 1))]
    return texts


@pytest.mark.parametrize("limits", [{}, {"FAMILY": 1000, "SETS": 7, "FAN": 2}, {"FAMILY": 1, "SETS": 3, "FAN": 3}])
def test_classes_equal_brute_force(spark, monkeypatch, limits):
    """Also where families take two rounds and keys are cut into many blocks."""
    for name, value in limits.items():
        monkeypatch.setattr(op12_signature_trees, name, value)
    texts = copies()
    wanted, links = plain_classes(texts)
    assert len(links) > 300 and len({w[2] for w in wanted}) > 100
    found = op12_signature_trees.query(spark, documents(spark, texts)).collect()
    assert {tuple(r) for r in found} == wanted


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 2**32))
def test_linked_sets_share_a_key(common_size, left, right, seed):
    own = np.random.default_rng(seed).integers(0, 1 << 63, common_size + left + right).astype(np.uint64)
    a = np.unique(own[: common_size + left])
    b = np.unique(np.concatenate([own[:common_size], own[common_size + left :]]))
    same = len(np.intersect1d(a, b))
    if op12_signature_trees.alike(same, len(a), len(b)) and len(a) + len(b) > 2 * same:
        keys = [set(op12_signature_trees.routing_keys(s).tolist()) for s in (a, b)]
        assert keys[0] & keys[1]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 60), st.integers(0, 8), st.integers(0, 2**32))
def test_nodes_above_linked_sets_pass(size, extra, seed):
    """The greatest possible overlap of two nodes is never below that of sets under them."""
    draw = np.random.default_rng(seed)
    sets = [np.unique(draw.integers(0, 1 << 63, size).astype(np.uint64)) for _ in range(4)]
    near = np.unique(np.concatenate([sets[0], draw.integers(0, 1 << 63, extra).astype(np.uint64)]))
    if op12_signature_trees.alike(len(sets[0]), len(sets[0]), len(near)):
        maps = [[op12_signature_trees.bitmap(s, 64) for s in g] for g in (sets, [near, *sets[2:]])]
        sizes = [[len(s) for s in g] for g in (sets, [near, *sets[2:]])]
        excess = [max(n - int(np.bitwise_count(m).sum()) for n, m in zip(*g, strict=True)) for g in zip(sizes, maps, strict=True)]
        assert op12_signature_trees.can_overlap(
            [np.bitwise_or.reduce(m) for m in maps], excess, [min(n) for n in sizes], [max(n) for n in sizes], 0, 1
        )


def test_rows_that_share_an_id_and_rows_without(spark):
    words = " ".join(f"w{i}" for i in range(100))
    rows = [(3, words), (3, "other words here"), (None, words + " x"), (None, None), (2, words + " y"), (3, words)]
    found = op12_signature_trees.query(spark, spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(
        map(str, [(3, 98, 2), (3, 1, 3), (None, 99, 2), (None, 0, None), (2, 99, 2), (3, 98, 2)])
    )


@needs_tables
def test_oracle_on_the_smallest_table(spark):
    found = op12_signature_trees.query(spark, common.documents(spark, SF)).collect()
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
        assert sorted(map(tuple, found)) == sorted(duck.execute(op12_signature_trees.ORACLE).fetchall())
