"""Mix sources to target weights by a min-cost flow over membership patterns.

Documents that belong to the same set of sources form a pattern, a node with their
words as capacity. The flow sends words from patterns to source quotas; using a
pattern's words again costs more each time. It runs over one row per pattern, made by
one aggregation; documents are then chosen in a seeded order, whole, until their
pattern's words are reached, and one more document closes most of what is left.

The cut of the seeded order is found from sums per slice of the order, so no source,
however large, is sorted as one group: only the slice in which the cut lies is.

Defined cases: a null text has size 0; a null source is a source of its own, after
all others; documents of size 0 are never taken; if no text has a word, all targets
are 0; rows with equal ids share their fate; a null id sorts first. No rows give no
rows.
"""

from __future__ import annotations

import json
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bourselake.llm.common import SPACES
from bourselake.llm.mincost import route
from bourselake.session import staged

#: By place of the source in code point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
EPOCHS = 2
SEED = "mix-1"
#: The order key has 52 bits; its first 16 name one of 65,536 slices.
KEY_BITS, SLICE_BITS = 52, 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACES}]+")), F.lit(0)).cast("bigint")


def order_key(doc_id: Column) -> Column:
    """A seeded 52-bit number of the id."""
    named = F.concat(F.lit(SEED + "/"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def targets(sizes: list[int], weights: list[int], share: Fraction, epochs: int) -> list[Fraction]:
    """Shares of ``share`` of all words by weight, none above ``epochs`` times its size.

    What a full source cannot take goes to the others by weight, until none is above.
    """
    total = share * sum(sizes)
    full: set[int] = set()
    while True:
        rest = total - sum(epochs * sizes[i] for i in full)
        weight = sum(w for i, w in enumerate(weights) if i not in full)
        level = rest / weight if weight else Fraction(0)
        above = {
            i
            for i in range(len(sizes))
            if i not in full and level * weights[i] > epochs * sizes[i]
        }
        if not above:
            break
        full |= above
    return [
        Fraction(epochs * s) if i in full else level * w
        for i, (s, w) in enumerate(zip(sizes, weights, strict=True))
    ]


def plan(spark: SparkSession, sized: DataFrame) -> DataFrame:
    """(_pattern, source_size, target, epochs, rest): one row per membership pattern.

    ``sized`` has _pattern, the JSON array of a document's sources, and _size. One row
    per pattern reaches the driver. target and source_size are those of the first source.
    """
    rows = sized.groupBy("_pattern").agg(F.sum("_size").alias("words")).collect()
    members = [json.loads(r["_pattern"]) for r in rows]
    names = sorted({s for m in members for s in m}, key=lambda s: (s is None, s or ""))
    place = {s: i for i, s in enumerate(names)}
    words = [int(r["words"]) for r in rows]
    sizes = [0] * len(names)
    for own, n in zip(members, words, strict=True):
        for s in own:
            sizes[place[s]] += n
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(names))]
    wanted = targets(sizes, weights, SHARE, EPOCHS)
    flow = route(
        words, [[place[s] for s in m] for m in members], [int(t) for t in wanted], EPOCHS
    )
    found = []
    for row, own, n, out in zip(rows, members, words, flow, strict=True):
        whole, rest = divmod(sum(out), n) if n else (0, 0)
        first = place[own[0]]
        found.append((row["_pattern"], sizes[first], float(wanted[first]), whole, rest))
    return spark.createDataFrame(
        found, "_pattern string, source_size bigint, target double, epochs int, rest bigint"
    )


def cuts(sized: DataFrame, planned: DataFrame) -> DataFrame:
    """``planned`` with the cut of each pattern's seeded order.

    Documents up to (cut_key, cut_id) are taken once more; so are those of pick_id.
    """
    bound = F.broadcast(planned)
    slice_ = F.shiftright("_key", KEY_BITS - SLICE_BITS).alias("slice")
    sums = sized.groupBy("_pattern", slice_).agg(F.sum("_size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("_pattern").orderBy("slice"))
    border = (
        sums.withColumn("upto", upto)
        .join(bound, "_pattern")
        .filter(F.col("upto") > F.col("rest"))
        .groupBy("_pattern")
        .agg(F.min(F.struct("slice", (F.col("upto") - F.col("words")).alias("before"))).alias("b"))
        .select("_pattern", "b.slice", "b.before")
    )
    edges = planned.join(border, "_pattern", "left")
    order = Window.partitionBy("_pattern").orderBy("_key", "_id")
    inside = (
        sized.join(F.broadcast(edges.filter("rest > 0")), "_pattern")
        .filter(F.shiftright("_key", KEY_BITS - SLICE_BITS) == F.col("slice"))
        .withColumn("upto", F.col("before") + F.sum("_size").over(order))
        .filter(F.col("upto") <= F.col("rest"))
        .groupBy("_pattern")
        .agg(F.max(F.struct("_key", "_id", "upto")).alias("c"))
    )
    cut = edges.join(inside, "_pattern", "left").select(
        *edges.columns,
        # Without a document in the slice the cut is the slice's lower edge.
        F.coalesce("c._key", F.shiftleft("slice", KEY_BITS - SLICE_BITS) - 1).alias("cut_key"),
        F.col("c._id").alias("cut_id"),
        (F.col("rest") - F.coalesce("c.upto", "before")).alias("left_over"),
    )
    miss = F.abs(F.col("_size") - F.col("left_over"))
    pick = (
        sized.join(F.broadcast(cut.filter("left_over > 0")), "_pattern")
        .filter(~_before_cut() & (miss < F.col("left_over")))
        .groupBy("_pattern")
        .agg(F.min(F.struct(miss.alias("miss"), "_key", "_id")).alias("p"))
        .select("_pattern", F.col("p._key").alias("pick_key"), F.col("p._id").alias("pick_id"))
    )
    return cut.join(pick, "_pattern", "left")


def _before_cut() -> Column:
    key, id_ = F.col("_key"), F.col("_id")
    at = (key == F.col("cut_key")) & (
        id_.isNull() | F.coalesce(id_ <= F.col("cut_id"), F.lit(False))
    )
    return (key < F.col("cut_key")) | at


def _measured(docs: DataFrame, members: Column) -> DataFrame:
    return docs.select(
        F.to_json(F.array_sort(F.array_distinct(members))).alias("_pattern"),
        word_count(F.col("text")).alias("_size"),
        order_key(F.col("doc_id")).alias("_key"),
        F.col("doc_id").cast("bigint").alias("_id"),
        F.struct("*").alias("_row"),
    )


def mixed(
    spark: SparkSession, docs: DataFrame, members: Column | None = None
) -> DataFrame:
    """_row, _size, source_size, target and _times, how often each document is taken.

    ``members`` is the array of a document's sources; its own source by default.
    """
    members = F.array("source") if members is None else members
    measured = _measured(docs, members)
    sized = staged(spark, measured.select("_pattern", "_size", "_key", "_id"), "sized")
    decided = staged(spark, cuts(sized, plan(spark, sized)), "cuts")
    again = F.coalesce((F.col("rest") > 0) & F.col("slice").isNotNull() & _before_cut(), F.lit(False))
    picked = F.coalesce(
        (F.col("_key") == F.col("pick_key")) & F.col("_id").eqNullSafe(F.col("pick_id")),
        F.lit(False),
    )
    times = F.col("epochs") + (again | picked).cast("int")
    # One row per pattern, already seen by the driver.
    return measured.join(F.broadcast(decided), "_pattern").select(
        "_row", "_size", "source_size", "target", times.alias("_times")
    )


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    rows = mixed(spark, docs.select("doc_id", "text", "source"))
    taken = (F.col("_size") * F.col("_times")).alias("taken")
    return rows.select(
        "_row.doc_id", F.col("_size").alias("size"), "source_size", "target", taken
    )


def mixture(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken."""
    rows = mixed(spark, docs).filter("_times > 0 and _size > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("_times")))
    return rows.select("_row", copies.alias("_copy")).select("_row.*")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('{SEED}/' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS k
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM s
), r AS (
  SELECT *, words * (10 // weight) AS ratio FROM w
), lev AS (
  SELECT a.*, 3 * (SELECT sum(words) FROM r) - 4 * coalesce(
           (SELECT sum(words) FROM r b WHERE b.ratio < a.ratio), 0) AS rest2,
         (SELECT sum(weight) FROM r b WHERE b.ratio >= a.ratio) AS left_weight
  FROM r a
), capped AS (
  SELECT *, 4 * words * left_weight < rest2 * weight AS is_full FROM lev
), t AS (
  SELECT source, words, weight,
         CASE WHEN is_full THEN 2 * words * 1.0::DOUBLE
              ELSE CAST(weight * (SELECT 3 * sum(words) - 4 * coalesce(sum(words) FILTER (is_full), 0)
                                  FROM capped) AS DOUBLE)
                   / CAST((SELECT 2 * sum(weight) FILTER (NOT is_full) FROM capped) AS DOUBLE)
         END AS target
  FROM capped
), q AS (
  SELECT *, CAST(floor(target) AS BIGINT) // greatest(words, 1) AS epochs,
         CASE WHEN words = 0 THEN 0 ELSE CAST(floor(target) AS BIGINT) % words END AS rest
  FROM t
), o AS (
  SELECT d.*, q.words, q.target, q.epochs, q.rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id) AS upto
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
), p AS (
  SELECT *, rest - coalesce(max(upto) FILTER (upto <= rest) OVER (PARTITION BY source), 0) AS gap
  FROM o
), z AS (
  SELECT *, CASE WHEN upto > rest AND abs(size - gap) < gap THEN row_number() OVER (
              PARTITION BY source, upto > rest AND abs(size - gap) < gap
              ORDER BY abs(size - gap), k, doc_id) END AS pick
  FROM p
)
SELECT doc_id, size, CAST(words AS BIGINT) AS source_size, target,
       CAST(size * (epochs + CASE WHEN rest > 0 AND upto <= rest OR pick = 1 THEN 1 ELSE 0 END)
            AS BIGINT) AS taken
FROM z
"""
