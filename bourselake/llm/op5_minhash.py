"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Each run of five words is hashed once; the top byte of the hash names one of 256 bins,
and a bin keeps its smallest hash. An empty bin takes the value of a bin chosen by hash,
again and again until a filled one is met (optimal densification). Of each bin the
four low bits are stored, one hexadecimal digit, so a fingerprint is 256 digits. Unequal
values agree in four bits once in 16, which the likeness corrects for.

A document's neighbour by id is found without one global sort: ids are cut into ranges
of about equal text at quantiles, each range is ordered by itself, and it also gets the
first document of the next range. The text moves once.

Defined cases: a null text is empty; fewer than five words are one run; a text without
words has a fingerprint of 256 dots, like only to its equals; null ids sort as the
smallest; rows with equal ids are ordered by text; a table of one row is its own
neighbour. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bourselake.llm.common import SPACES, part_count

SHINGLE, BINS, BITS = 5, 256, 4
#: Bins that an empty one asks by hash before all filled ones are ranked by hash.
PROBES = 10
EMPTY = "."
#: Characters of text in a range of ids, about.
RANGE_CHARS = 8_000_000
LEAST = -(1 << 63)


def _bin(value: Column) -> Column:
    return (F.shiftright(value, 56) + (BINS // 2)).cast("int")


def _digit(value: Column) -> Column:
    return F.lower(F.hex(value.bitwiseAND(F.lit((1 << BITS) - 1))))


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Add the array of 256 digits of the text in column ``text`` as ``name``.

    Arrays that a later step looks into more than once are columns of their own, so
    that they are made once per row.
    """
    words, sorted_, least, dense = (f"{name}_{s}" for s in ("words", "sorted", "least", "dense"))
    split = F.array_remove(F.split(F.col(text), f"[{SPACES}]+"), "")
    hashes = F.transform(split, lambda w: F.xxhash64(w))
    rows = rows.withColumn(words, hashes)
    own = F.col(words)
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(own) - SHINGLE, F.lit(0))),
        # Words beyond the end are null, and a hash leaves nulls out.
        lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(SHINGLE)]),
    )
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn(sorted_, F.when(F.size(own) == 0, none).otherwise(F.sort_array(runs)))
    own = F.col(sorted_)
    first = F.filter(own, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(own, i - 1))))
    rows = rows.withColumn(least, first)
    mins = F.col(least)

    def spaced(h: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(_bin(F.get(mins, i - 1)))
        return F.concat(F.repeat(F.lit(EMPTY), _bin(h) - before - 1), _digit(h))

    line = F.rpad(F.array_join(F.transform(mins, spaced), ""), BINS, EMPTY)
    rows = rows.withColumn(dense, F.split(line, ""))
    digits = F.col(dense)

    def filled(c: Column, i: Column) -> Column:
        asked = [
            F.nullif(F.get(digits, F.pmod(F.xxhash64(i, F.lit(k)), F.lit(BINS)).cast("int")), F.lit(EMPTY))
            for k in range(PROBES)
        ]
        ranked = F.array_min(
            F.transform(mins, lambda h: F.struct(F.xxhash64(i, _bin(h)).alias("r"), _digit(h).alias("d")))
        )
        return F.coalesce(F.nullif(c, F.lit(EMPTY)), *asked, ranked["d"], F.lit(EMPTY))

    return rows.withColumn(name, F.transform(digits, filled)).drop(words, sorted_, least, dense)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common runs, from 0 to 1, corrected for chance agreement."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e))
    chance = 2.0**-BITS
    return F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds lie at or below the key, in two short looks."""
    width = max(1, int(len(bounds) ** 0.5))
    coarse = F.array(*[F.lit(b).cast("bigint") for b in bounds[width - 1 :: width]])
    fine = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    skipped = F.size(F.filter(coarse, lambda b: b <= key)) * width
    return skipped + F.size(F.filter(F.slice(fine, skipped + 1, width), lambda b: b <= key))


def with_neighbours(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, Window]:
    """Documents in ranges with a copy of the next range's first one, and their order.

    Columns doc_id, text, _key, _range and _ghost, 1 for the copies. In the order, the
    row after a document is its neighbour by descending id; after the last, the first.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "_key", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST).cast("bigint"))
    )
    chars = own.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = 2 * part_count(spark, chars, RANGE_CHARS)
    shares = [k / ranges for k in range(1, ranges)]
    cuts = own.agg(F.percentile_approx("_key", shares, 20 * ranges)).first()[0] if shares else []
    bounds = sorted(set(cuts or []))
    own = own.withColumn("_range", _range_of(F.col("_key"), bounds) if bounds else F.lit(0))
    # One row per range reaches the driver.
    tops = sorted(own.groupBy("_range").agg(F.max("_key").alias("top")).collect(), reverse=True)
    heads = [
        (tops[(n + 1) % len(tops)]["top"], row["_range"], 1) for n, row in enumerate(tops)
    ]
    head = spark.createDataFrame(heads, "_key bigint, _range int, _ghost int")
    ghosts = own.drop("_range").join(F.broadcast(head), "_key")
    order = Window.partitionBy("_range").orderBy("_ghost", F.col("_key").desc(), "text")
    return own.withColumn("_ghost", F.lit(0)).unionByName(ghosts), order


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    rows, order = with_neighbours(spark, docs)
    length = F.length("text")
    half = F.floor(length / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), length - half),
        F.substring(F.lead("text").over(order), F.lit(1), half),
    )
    # The copies at the ends have no successor; theirs is never looked at.
    rows = rows.withColumn("_edited", F.coalesce(edited, F.lit("")))
    rows = with_fingerprint(rows, "text", "_own")
    rows = rows.withColumn("_next", F.lead("_own").over(order)).filter("_ghost = 0")
    rows = with_fingerprint(rows, "_edited", "_other")
    return rows.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        F.array_join("_own", "").alias("fingerprint"),
        F.array_join("_other", "").alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_other")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next")).alias("near_next"),
    )
