"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import zlib

import duckdb
import pytest

from bourselake.llm import common, op11_merkle
from tests.llm.fixtures import SF, awkward, awkward_rows, needs_tables


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(bottom):
    levels = [bottom]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([digest(*now[i : i + 3]) for i in range(0, len(now), 3)])
    return levels


def plain_path(levels, at):
    path = []
    for level in levels[:-1]:
        first = at - at % 3
        path.append((level[first:at], level[at + 1 : first + 3]))
        at //= 3
    return path


def plain_manifest(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of (doc_id, source, ...)."""
    def tampered(row):
        even = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
        return (*row[:4], row[4].replace("\n", "")) if even and row[4] is not None else row

    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
    trees = {s: plain_tree([plain_leaf(r) for r in groups[s]]) for s in sources}
    top = plain_tree([trees[s][-1][0] for s in sources])
    out = []
    for place, source in enumerate(sources):
        for at, row in enumerate(groups[source]):
            path = plain_path(trees[source], at) + plain_path(top, place)
            folded = plain_leaf(tampered(row))
            for before, after in path:
                folded = digest(*before, folded, *after)
            proof = digest(*[h for before, after in path for h in (*before, *after)])
            root = top[-1][0]
            out.append((row[0], plain_leaf(row), trees[source][-1][0], root, proof, folded, folded == root))
    return out


def compared(rows):
    return sorted(tuple(str(v) for v in r) for r in rows)


SIZES = {None: 4, "a": 1, "b": 2, "c": 3, "é": 28, "d": 250, "e": 9}


@pytest.mark.parametrize(("hops", "share"), [(5, 60_000), (1, 2), (2, 5)])
def test_manifest_equals_a_plain_tree(spark, monkeypatch, hops, share):
    """Long climbs, copies of the upper rows, and sources of all kinds of sizes."""
    monkeypatch.setattr(op11_merkle, "HOPS", hops)
    monkeypatch.setattr(op11_merkle, "SPAN", 3**hops)
    monkeypatch.setattr(op11_merkle, "SHARE", share)
    monkeypatch.setattr(op11_merkle, "CLIMB", op11_merkle.climb_sql())
    rows, i = [], 0
    for source, n in SIZES.items():
        for _ in range(n):
            text = None if i % 31 == 0 else f"line {i}\nnext" if i % 3 else f"one line {i}"
            rows.append((i, source, "en" if i % 5 else None, i, text))
            i += 1
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    found = op11_merkle.query(spark, docs.repartition(5)).collect()
    assert compared(found) == compared(plain_manifest(rows))
    states = {(r["verified"], "\n" in (rows[r["doc_id"]][4] or "")) for r in found}
    assert states == {(True, False), (True, True), (False, True)}


def test_awkward_rows_and_single_leaves(spark):
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in awkward_rows()]
    found = op11_merkle.query(spark, awkward(spark)).collect()
    assert compared(found) == compared(plain_manifest(rows))
    one = awkward(spark).filter("doc_id = 9")
    (row,) = op11_merkle.query(spark, one).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["verified"]
    assert row["proof_sha256"] == digest()


def test_the_session_keeps_its_row_limit(spark):
    before = spark.conf.get(op11_merkle.ROW_LIMIT)
    op11_merkle.query(spark, awkward(spark))
    assert spark.conf.get(op11_merkle.ROW_LIMIT) == before


@needs_tables
def test_oracle_on_the_smallest_table(spark):
    found = op11_merkle.query(spark, common.documents(spark, SF)).collect()
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
        assert compared(found) == compared(duck.execute(op11_merkle.ORACLE).fetchall())
