"""Helpers that the text operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.session import staged

#: Rows of a key filter at most: 64 bits each, so a broadcast holds 16 MB of bits.
FILTER_WORDS = 1 << 20

SPACES = "\\x20\\x09-\\x0D"
#: Rows that go to Python at once. Whole texts are long, and both sides hold a batch.
BATCH_ROWS = 512


def bound_batches(spark: SparkSession) -> None:
    """Let at most ``BATCH_ROWS`` rows go to Python at once in this session."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def id_remainder(divisor: int) -> Column:
    """crc32(doc_id as text) mod divisor; a null id counts as 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % divisor


def part_count(spark: SparkSession, rows: int, rows_per_part: int) -> int:
    """Parts of bounded size, and enough of them for all cores."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(rows / rows_per_part))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8."""
    return (text or "").encode().lower().split()


def key_filter(keys: DataFrame, name: str, words: int = FILTER_WORDS) -> DataFrame:
    """A bit set of hashed 64-bit keys in at most ``words`` rows of 64 bits.

    Its size does not grow with the keys: a full filter lets more rows pass, and
    what it lets pass has to be checked exactly.
    """
    word, bit = _filter_place(F.col(name), words)
    return keys.groupBy(word.alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("_bits")
    )


def _filter_place(key: Column, words: int) -> tuple[Column, Column]:
    mixed = F.xxhash64(key)
    return (
        F.pmod(F.shiftright(mixed, 6), F.lit(words)).cast("int"),
        mixed.bitwiseAND(F.lit(63)).cast("int"),
    )


def mark_possible(
    rows: DataFrame, keys: DataFrame, name: str, flag: str, words: int = FILTER_WORDS
) -> DataFrame:
    """Add ``flag``: false for rows whose key is surely not among ``keys``.

    Only the filter is moved, so rows that cannot match need no shuffle.
    """
    word, bit = _filter_place(F.col(name), words)
    filled = F.broadcast(key_filter(keys, name, words))
    hit = F.getbit(F.coalesce("_bits", F.lit(0).cast("bigint")), bit) == 1
    return (
        rows.withColumn("_word", word)
        .join(filled, "_word", "left")
        .withColumn(flag, hit)
        .drop("_word", "_bits")
    )


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and every row whole as ``_row``.

    Columns an operator adds cannot clash with names inside the struct.
    """
    return docs.select(*needed, F.struct("*").alias("_row"))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, by alternating stars.

    ``edges`` has bigint columns a and b. Each round points every node at the
    smallest neighbour, first for its larger and then for its smaller neighbours,
    and is written to the shared scratch folder; the rounds grow with the logarithm
    of the component size. Nodes without an edge do not appear.
    """
    now = staged(spark, edges.filter("a <> b").select(*_ordered()).distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least, "a")
            .filter("b > a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .select(*_ordered())
            .distinct()
        )
        # Now b > a holds: small stars look from each node at its smaller neighbours.
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b").select(
            F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b"),
            F.col("m").alias("a"),
        )
        after = staged(spark, small.filter("a <> b").select(*_ordered()).distinct(), "edges")
        if _summary(after) == _summary(now):
            break
        now = after
    members = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return members.unionByName(roots)


def _ordered() -> tuple[Column, Column]:
    return F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")


def _summary(edges: DataFrame) -> tuple:
    """Count and an order-free hash of a distinct edge set."""
    return tuple(
        edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.min("a"), F.max("b")).first()
    )
