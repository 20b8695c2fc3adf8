"""SimHash and exact deduplication against brute force."""

import random
from itertools import combinations

import duckdb
import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bourselake.llm import common, golomb, op1_simhash, op7_exact_dedup
from tests.llm.fixtures import LONG, SF, awkward, documents, needs_tables


def plain_simhash(text):
    words = [w for w in text.encode().lower().split()]
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def plain_components(links, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def near_texts(seed=5):
    """Long texts with copies that change one word, chains of them, and others."""
    draw = random.Random(seed)
    texts = []
    for _ in range(12):
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.choice([3, 60, 900]))]
        for _ in range(draw.randrange(1, 8)):
            texts.append(" ".join(words))
            words = list(words)
            words[draw.randrange(len(words))] = f"x{draw.randrange(5000)}"
    return texts + ["", "one", "one two", LONG]


def test_fingerprints_and_components_equal_brute_force(spark):
    texts = near_texts()
    found = op1_simhash.query(spark, documents(spark, texts)).collect()
    own = [plain_simhash(t) for t in texts]
    assert {r["doc_id"]: r["fingerprint"] for r in found} == {
        i: f"{h:016x}" for i, h in enumerate(own)
    }
    links = [
        (a, b)
        for a, b in combinations(range(len(texts)), 2)
        if (own[a] ^ own[b]).bit_count() <= 2
    ]
    assert links, "the fixture has linked pairs"
    assert {r["doc_id"]: r["component_id"] for r in found} == plain_components(
        links, range(len(texts))
    )


def test_a_dense_ball_of_fingerprints_is_one_component(spark):
    """A large group of near copies: every list is dense, and no list emits its pairs."""
    base = 0x0123456789ABCDEF
    ball = {base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)} | {base}
    far = base ^ 0xFFFF_0000_0000
    values = np.array(sorted(ball | {far}), dtype=np.uint64).view(np.int64)
    entries = spark.createDataFrame([(int(v),) for v in values], "fingerprint bigint")
    links = op1_simhash.fingerprint_links(op1_simhash.posting_lists(entries, 6), 2, 6)
    assert links.count() <= 28 * len(values)
    parts = common.components(spark, links)
    assert parts.select("component").distinct().count() == 1
    assert parts.count() == len(ball)


def test_star_links_connect_what_brute_force_connects():
    draw = np.random.default_rng(3)
    values = np.unique(draw.integers(0, 1 << 12, 300).astype(np.uint64))
    pairs = [
        (int(a), int(b)) for a, b in combinations(values, 2) if int(a ^ b).bit_count() <= 2
    ]
    nodes = [int(v) for v in values]
    found = op1_simhash.star_links(values, 2, 6)
    assert plain_components(found, nodes) == plain_components(pairs, nodes)


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)]
    edges += [(100, i) for i in range(101, 160)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    table = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in common.components(spark, table).collect()}
    assert found == plain_components(edges, {n for e in edges for n in e})


def test_exact_groups_equal_the_oracle(spark):
    docs = awkward(spark)
    plain = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = op7_exact_dedup.query(spark, docs)
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", plain)
    wanted = duck.execute(op7_exact_dedup.ORACLE).fetchall()

    def known(rows):
        # kept of a null id is a case of its own: a null is what stays only without ids.
        return sorted((str(r[:3]) + r[4]) for r in rows)

    assert known([tuple(r) for r in found.collect()]) == known(wanted)


def test_unmarked_texts_are_not_shuffled(spark):
    texts = [f"text number {i}" for i in range(300)] + ["copy"] * 200
    docs = documents(spark, texts)
    marked = op7_exact_dedup.suspect_hashes(spark, docs, hashes_per_owner=50)
    assert marked.count() == 1
    rows = op7_exact_dedup.with_suspicion(spark, docs)
    assert rows.filter("_suspect").count() == 200


def test_a_full_key_filter_still_gives_whole_results(spark):
    docs = documents(spark, [str(i) for i in range(500)])
    keys = spark.range(0, 500, 2).withColumnRenamed("id", "doc_id")
    marked = common.mark_possible(docs, keys, "doc_id", "_maybe", words=1)
    assert marked.filter("_maybe").count() > 250
    assert marked.filter("not _maybe and doc_id % 2 = 0").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, (1 << 64) - 1), max_size=200))
def test_golomb_round_trip(hashes):
    values = np.array(sorted(hashes), dtype=np.uint64)
    assert (golomb.decode(golomb.encode(values)) == values).all()


def test_golomb_is_smaller_than_plain_hashes():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    assert len(golomb.encode(values)) < 0.9 * 8 * len(values)


@needs_tables
def test_exact_stage_keeps_what_the_operator_keeps(spark):
    docs = common.documents(spark, SF)
    kept = op7_exact_dedup.query(spark, docs).filter("kept").select("doc_id")
    stage = op7_exact_dedup.without_copies(spark, docs)
    assert sorted(stage.collect()) == sorted(docs.join(kept, "doc_id").select(*docs.columns).collect())
    assert stage.agg(F.count_distinct(op7_exact_dedup.normalised(F.col("text")))).first()[0] == (
        stage.count()
    )


def test_near_stage_keeps_the_smallest_id_of_each_brute_force_component(spark):
    texts = near_texts(9)
    own = [plain_simhash(t) for t in texts]
    links = [(a, b) for a, b in combinations(range(len(own)), 2) if (own[a] ^ own[b]).bit_count() <= 2]
    parts = plain_components(links, range(len(own)))
    kept = op1_simhash.without_near_duplicates(spark, documents(spark, texts))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(parts.values()))
    assert 0 < len(set(parts.values())) < len(texts)


def test_near_stage_decides_rows_that_share_an_id_by_their_texts(spark):
    words = " ".join(f"w{i}" for i in range(400))
    rows = [(1, words), (5, words + " x"), (5, "another text"), (5, "another text"), (None, words), (None, "alone")]
    assert (plain_simhash(words) ^ plain_simhash(words + " x")).bit_count() <= 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted((str(r[0]), r[1]) for r in op1_simhash.without_near_duplicates(spark, docs).collect())
    assert kept == [("1", words), ("5", "another text"), ("None", "alone")]
