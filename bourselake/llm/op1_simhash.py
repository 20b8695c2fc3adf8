"""Near duplicates by SimHash over an inverted index of byte positions.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ in at
most d bits share at least 8 - d of them, so with d = 2 a linked pair shares six:
the guaranteed minimum of the count filter. Posting lists of single bytes would hold
1/256 of the corpus each and grow with its square. The index therefore has one list
for every choice of that many positions with their bytes: two fingerprints meet in a
list exactly if their tally of shared positional bytes reaches the minimum. A list has
at most 2^16 distinct fingerprints at any corpus size, the two open bytes. The key of a
list is thus the count filter: sharing it is reaching the tally. Within a list the differing
bits of a pair are verified; each fingerprint then links to one representative of its connected part, so that no
list emits its pairs.

Equal fingerprints are one entry before the index, so copies cost nothing.

Defined cases: a null or empty text has fingerprint zero; fewer words than a shingle
make one shingle of all; a bit is set if more than half of the shingles have it,
repeats counted, a tie clears it; null ids take part and never name a component unless
it has no other id; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.llm.common import bound_batches, components, mark_possible, words_of
from bourselake.session import staged

POSITIONS = 8
SEED = 42


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, space-joined; fewer words are one run."""
    words = words_of(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = max(1, len(words) - size + 1)
    firsts = starts[:last].tolist()
    stops = ends[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(firsts, stops, strict=True)),
        dtype=np.uint64,
        count=last,
    )


def simhash(text: str | None, size: int) -> int:
    hashes = shingle_hashes(text, size)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        block = hashes[start : start + (1 << 16)].astype(">u8").view(np.uint8)
        ones += np.unpackbits(block.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = 2 * ones > len(hashes)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, *more: str) -> DataFrame:
    """(doc_id, more columns, fingerprint bigint) of every document."""

    @F.pandas_udf("bigint")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            own = np.array([simhash(t, shingle) for t in texts], dtype=np.uint64)
            yield pd.Series(own.view(np.int64))

    return docs.select(
        F.col("doc_id").cast("bigint"), *more, compute("text").alias("fingerprint")
    )


def _mask(positions: tuple[int, ...]) -> int:
    mask = sum(0xFF << (8 * p) for p in positions)
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def posting_lists(entries: DataFrame, shared: int) -> DataFrame:
    """Lists of two or more fingerprints that share ``shared`` positional bytes.

    ``entries`` has distinct fingerprints; a list holds them as an array.
    """
    masks = F.array(*[F.lit(_mask(p)).cast("bigint") for p in combinations(range(8), shared)])
    own = F.col("fingerprint")
    return (
        entries.select(own, F.posexplode(masks).alias("positions", "mask"))
        .select(own, "positions", own.bitwiseAND(F.col("mask")).alias("bytes"))
        .groupBy("positions", "bytes")
        .agg(F.collect_list("fingerprint").alias("list"))
        .filter(F.size("list") > 1)
        .select("list")
    )


def star_links(values: np.ndarray, max_bits: int, shared: int) -> list[tuple[int, int]]:
    """Links from each fingerprint of a list to the first of its connected part.

    A pair is linked if its tally of shared bytes reaches ``shared`` and it differs
    in at most ``max_bits`` bits. The search goes breadth first from the first value
    not yet reached and looks at every value that is still open once per step.
    """
    links = []
    open_ = np.unique(values)
    while len(open_) > 1:
        root, open_ = open_[0], open_[1:]
        front = [root]
        while front and len(open_):
            apart = open_ ^ front.pop()
            same = (apart.astype(">u8").view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = (same >= shared) & (np.bitwise_count(apart) <= max_bits)
            reached = open_[near]
            links += [(int(root), int(v)) for v in reached]
            front += list(reached)
            open_ = open_[~near]
    return links


def fingerprint_links(lists: DataFrame, max_bits: int, shared: int) -> DataFrame:
    """(a, b) links within the posting lists, at most one per entry and list."""

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                pair
                for own in batch["list"]
                for pair in star_links(
                    np.asarray(own, dtype=np.int64).view(np.uint64), max_bits, shared
                )
            ]
            pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return lists.mapInPandas(link, "a bigint, b bigint")


def fingerprint_classes(
    spark: SparkSession, own: DataFrame, max_bits: int
) -> DataFrame:
    """(fingerprint, component_id) of every fingerprint in ``own`` (doc_id, fingerprint)."""
    shared = POSITIONS - max_bits
    if not 1 <= shared < POSITIONS:
        raise ValueError("max_bits must lie between 1 and 7")
    entries = staged(
        spark, own.groupBy("fingerprint").agg(F.min("doc_id").alias("node")), "entries"
    )
    links = fingerprint_links(posting_lists(entries, shared), max_bits, shared)
    parts = components(spark, links)
    named = (
        entries.join(parts.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .withColumn("part", F.coalesce("component", "fingerprint"))
        .drop("component")
    )
    smallest = named.groupBy("part").agg(F.min("node").alias("component_id"))
    return named.join(smallest, "part").select("fingerprint", "component_id", "part")


def near_duplicates(
    spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    bound_batches(spark)
    own = staged(spark, fingerprints(docs, shingle), "fingerprints")
    classes = fingerprint_classes(spark, own, max_bits).drop("part")
    return own.join(classes, "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def without_near_duplicates(
    spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """One whole document of each component: that with the smallest doc_id.

    Rows are told apart by id and text, so rows that share an id are decided each by its own
    text; of equal ids in a component the row with the smallest hash stays, of equal rows
    one. Rows that are surely neither dropped nor repeated pass without a shuffle.
    """
    bound_batches(spark)
    key = F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text")).alias("row_key")
    keyed = docs.select("doc_id", "text", key)
    own = staged(spark, fingerprints(keyed, shingle, "row_key"), "fingerprints")
    parts = fingerprint_classes(spark, own, max_bits).select("fingerprint", "part")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    rows = own.groupBy("fingerprint", "doc_id", "row_key").agg(F.count("*").alias("n"))
    rows = staged(spark, rows.join(parts, "fingerprint"), "rows")
    first = rows.groupBy("part").agg(F.min(order).alias("first"))
    decided = (
        rows.join(first, "part")
        .select("row_key", "n", (F.col("row_key") == F.col("first.row_key")).alias("_stays"))
        .filter(~F.col("_stays") | (F.col("n") > 1))
        .select("row_key", "_stays")
        .distinct()
    )
    decided = staged(spark, decided, "decided")
    whole = docs.select(key, F.struct("*").alias("_row"))
    marked = mark_possible(whole, decided, "row_key", "_maybe")
    checked = marked.filter("_maybe").join(decided, "row_key", "left")
    once = checked.filter("_stays").groupBy("row_key").agg(F.first("_row").alias("_row"))
    kept = marked.filter(~F.col("_maybe")).select("_row").unionByName(
        checked.filter(F.col("_stays").isNull()).select("_row")
    )
    return kept.unionByName(once.select("_row")).select("_row.*")


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return near_duplicates(spark, docs)
