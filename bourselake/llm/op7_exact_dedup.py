"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Every input partition sorts the distinct 64-bit fingerprints of its texts, splits
them by owner (a range of hashes) and sends each owner one Golomb-coded message.
The owner merges its messages and answers each with a bitmap: which of your
fingerprints occurred elsewhere, or twice with you. Only texts whose fingerprint
is so marked are shuffled, and compared byte by byte as grouping keys.

Unmarked texts never move. A group of copies, however large, sends one fingerprint
per partition, and its texts are combined in each task before the shuffle.

Defined cases: a null text equals an empty one; rows with equal texts form one
group whatever their other columns hold; of null ids the largest non-null id stays,
and a group without any keeps one row with a null id; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.llm import golomb
from bourselake.llm.common import mark_possible, packed, part_count
from bourselake.session import staged

#: Hashes that one owner merges, about; owners grow with the input.
HASHES_PER_OWNER = 2_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z in lower case, other letters untouched; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def fingerprint(text: Column) -> Column:
    """A 64-bit hash that is equal for texts equal after ``normalised``.

    Full lower-casing after A-Z lower-casing changes nothing more, so the hash of
    the fully lower-cased text is a function of the normalised one.
    """
    return F.xxhash64(F.lower(F.coalesce(text, F.lit(""))))


def send(hashes: DataFrame, owners: int) -> DataFrame:
    """(part, owner, message, twice): one message per partition and owner.

    ``twice`` holds the positions of hashes the partition itself has repeatedly.
    """
    width = (1 << 64) // owners + 1

    def messages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        own = [b["fingerprint"].to_numpy().astype(np.int64) for b in batches]
        if not own:
            return
        values, counts = np.unique(np.concatenate(own).view(np.uint64), return_counts=True)
        edges = np.array([k * width for k in range(1, owners)], dtype=np.uint64)
        cuts = [0, *np.searchsorted(values, edges), len(values)]
        rows = [
            (
                part,
                owner,
                golomb.encode(values[a:b]),
                np.packbits(counts[a:b] > 1).tobytes(),
            )
            for owner, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
            if b > a
        ]
        yield pd.DataFrame(rows, columns=["part", "owner", "message", "twice"])

    schema = "part int, owner int, message binary, twice binary"
    return hashes.select("fingerprint").mapInPandas(messages, schema)


def answer(messages: DataFrame) -> DataFrame:
    """(part, owner, bitmap): set bits are hashes that occur more than once."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        lists = [golomb.decode(m) for m in group["message"]]
        merged, counts = np.unique(np.concatenate(lists), return_counts=True)
        repeated = merged[counts > 1]
        bitmaps = []
        for own, twice in zip(lists, group["twice"], strict=True):
            local = np.unpackbits(np.frombuffer(twice, dtype=np.uint8), count=len(own))
            bitmaps.append(np.packbits(np.isin(own, repeated) | (local == 1)).tobytes())
        return group[["part", "owner"]].assign(bitmap=bitmaps)

    return messages.groupBy("owner").applyInPandas(merge, "part int, owner int, bitmap binary")


def marked_hashes(messages: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Distinct fingerprints that the answers mark, read off each sender's message."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for message, bitmap in zip(batch["message"], batch["bitmap"], strict=True):
                own = golomb.decode(message)
                bits = np.unpackbits(np.frombuffer(bitmap, dtype=np.uint8), count=len(own))
                yield pd.DataFrame({"fingerprint": own[bits == 1].view(np.int64)})

    met = messages.select("part", "owner", "message").join(bitmaps, ["part", "owner"])
    return met.select("message", "bitmap").mapInPandas(read, "fingerprint bigint").distinct()


def suspect_hashes(
    spark: SparkSession, docs: DataFrame, hashes_per_owner: int = HASHES_PER_OWNER
) -> DataFrame:
    """The fingerprints that more than one document has, by the exchange."""
    hashes = docs.select(fingerprint(F.col("text")).alias("fingerprint"))
    owners = part_count(spark, docs.count(), hashes_per_owner)
    messages = staged(spark, send(hashes, owners), "messages")
    return staged(spark, marked_hashes(messages, answer(messages)), "marked")


def with_suspicion(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Documents with ``_fingerprint`` and ``_suspect``; a few suspects are unique."""
    marked = suspect_hashes(spark, docs).withColumnRenamed("fingerprint", "_fingerprint")
    hashed = docs.withColumn("_fingerprint", fingerprint(F.col("text")))
    return mark_possible(hashed, marked, "_fingerprint", "_suspect")


def duplicate_groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document."""
    rows = with_suspicion(spark, docs.select("doc_id", "text")).select(
        "doc_id", "_suspect", "_fingerprint", normalised(F.col("text")).alias("_text")
    )
    sha = F.sha2("_text", 256).alias("text_sha256")
    alone = rows.filter(~F.col("_suspect")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        sha,
    )
    suspects = rows.filter("_suspect")
    # The texts are the grouping key: equal bytes, not equal hashes, make a group.
    groups = (
        suspects.groupBy("_fingerprint", "_text")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("_fingerprint", sha, "keep_id", "group_size")
    )
    found = suspects.select("doc_id", "_fingerprint", sha).join(
        groups, ["_fingerprint", "text_sha256"]
    )
    return (
        alone.unionByName(found.drop("_fingerprint"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    )


def without_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One whole document of each group, that with the largest doc_id."""
    rows = with_suspicion(spark, packed(docs, "doc_id", "text"))
    alone = rows.filter(~F.col("_suspect")).select("_row.*")
    least = F.lit(-(1 << 63)).cast("bigint")
    best = F.max_by("_row", F.coalesce(F.col("doc_id").cast("bigint"), least))
    kept = (
        rows.filter("_suspect")
        .groupBy("_fingerprint", normalised(F.col("text")).alias("_text"))
        .agg(best.alias("_row"))
        .select("_row.*")
    )
    return alone.unionByName(kept)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return duplicate_groups(spark, docs)


ORACLE = f"""
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM n
"""
