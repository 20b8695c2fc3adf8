"""Jaccard join of shingle sets by a forest of signature trees.

A signature tree holds sets in its leaves; every node above has the OR of the bitmaps of
their tokens, the range of their sizes and the most tokens any of them has beyond its bits
(bits that tokens share). Two nodes can only cover a linked pair if the greatest overlap of
their sets, the least of both maximum sizes and of the common bits plus that excess, reaches
what the smallest sizes need. The join descends two nodes at once, drops node pairs that
fail, and compares token sets at the leaves. Node pairs whose sets are all in one part
already are dropped as well: what is asked for are the parts.

One tree over everything does not spread over tasks, and bits of a million texts are all
set. So there is one tree per routing key, and every linked pair meets in a tree: two sets
of similarity 0.9 differ in at most k = (|a| + |b|) / 19 tokens, hence at least one of k + 1
buckets of the hashed tokens is equal in both. k follows from a band of sizes; sizes of
linked sets lie in one band or in two neighbours, so a set has the keys of its own band and
of the one below. There are a few buckets more than that, so that empty ones, in which
strangers agree, need no key unless a set has more of them than were added. Equal sets are
one set before all this, and keys with the same sets are one key.

Keys with the same smallest set are a family: mostly the copies of one text, in many
subsets. A family goes to one task, each set once, and its trees share the parts found, so
that the second tree of a family has little left to do.

A family of more than ``FAMILY`` tokens goes two rounds. In the first, each set is in one
tree, that of its fullest key. The second takes the keys that still hold several parts,
whole. Keys of more than ``SETS`` sets or ``TOKENS`` tokens are cut into blocks, each of them
the tree below one node; large parts get blocks of their own. The node pairs of these blocks
are joined by Spark with the same tests, and only pairs that pass are descended, so a large
group of copies costs its size. What is quadratic in the worst case are the blocks of one
key whose sets are unlike each other and still pass the tests.

The tests never drop a linked pair, so the parts are those of the exact join. Tokens are
64-bit hashes of shingles.

Defined cases: null and blank texts have no set (size 0) and stay alone; fewer words than a
shingle are one shingle; repeated rows and ids take part row by row; null ids take part and
never name a component unless it has no other id; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.llm.common import bound_batches, components, mark_possible, part_count
from bourselake.llm.op1_simhash import SEED, shingle_hashes
from bourselake.session import staged

SHINGLE = 3
#: Sets and tokens of a tree, children of a node, tokens of a family and of a task.
SETS, TOKENS, FAN, FAMILY, TASK_TOKENS = 2_000, 1_000_000, 8, 1_000_000, 4_000_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def alike(common: int, a: int, b: int) -> bool:
    """100 * intersection >= 90 * union."""
    return 190 * common >= 90 * (a + b)


def _band_starts() -> np.ndarray:
    """Smallest size of each band; sizes of a band differ by a ninth at most."""
    starts = [1]
    while starts[-1] < 1 << 32:
        starts.append(10 * starts[-1] // 9 + 1)
    return np.array(starts)


BANDS = _band_starts()


def largest(band: int) -> int:
    return int(BANDS[band + 1]) - 1


def differing(band: int) -> int:
    """The tokens at most that linked sets meeting in this band differ in."""
    return (largest(band) + 10 * largest(band) // 9) // 19


def spare(band: int) -> int:
    """Buckets beyond those needed: this many may be empty and have no key."""
    return 2 + differing(band) // 500


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * GOLDEN
    return values ^ (values >> np.uint64(29))


def tokens_of(text: str | None) -> np.ndarray:
    """The distinct shingle hashes, ascending."""
    return np.unique(shingle_hashes(text, SHINGLE))


def set_id(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes(), SEED)).view(np.int64))


def routing_keys(tokens: np.ndarray) -> np.ndarray:
    """Keys of the set's band and the one below: band in the top byte, then bucket contents.

    In bands without difference only equal sets are linked, so they have no key.
    """
    if not len(tokens):
        return np.empty(0, dtype=np.int64)
    own = int(np.searchsorted(BANDS, len(tokens), side="right")) - 1
    keys = []
    for band in (own, own - 1):
        if band < 0 or differing(band) == 0:
            continue
        sums = np.zeros(differing(band) + 1 + spare(band), dtype=np.uint64)
        bucket = (tokens % np.uint64(len(sums))).astype(np.int64)
        np.add.at(sums, bucket, mixed(tokens))
        named = mixed(sums ^ mixed(np.arange(1, len(sums) + 1, dtype=np.uint64) * GOLDEN))
        filled = np.bincount(bucket, minlength=len(sums)) > 0
        if (~filled).sum() <= spare(band):
            named = named[filled]
        keys.append((named >> np.uint64(8)) | np.uint64(band << 56))
    return np.concatenate(keys).view(np.int64) if keys else np.empty(0, dtype=np.int64)


def bitmap_bits(key: int) -> int:
    """Bits of all bitmaps under a key: four times the largest size that meets there."""
    band = (key >> 56) & 0xFF
    return 1 << min(17, max(6, (4 * largest(band + 1)).bit_length()))


def bitmap(tokens: np.ndarray, bits: int) -> np.ndarray:
    flags = np.zeros(bits, dtype=bool)
    flags[(tokens & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags).view(np.uint64)


def can_overlap(maps, excess, low, high, x: int, y: int) -> bool:
    """Whether any two sets below nodes x and y may be linked."""
    most = min(int(high[x]), int(high[y]))
    least = int(low[x]) + int(low[y])
    if 190 * most < 90 * least:
        return False
    common = int(np.bitwise_count(maps[x] & maps[y]).sum()) + min(int(excess[x]), int(excess[y]))
    return 190 * min(most, common) >= 90 * least


class Sets:
    """Token sets with the parts they are in, and what the trees over them have learnt."""

    def __init__(self, sets: list[np.ndarray], parts: np.ndarray):
        self.sets, self.sizes = sets, np.array([len(s) for s in sets])
        self.parts = np.unique(parts, return_inverse=True)[1]
        self.first = np.array([s[0] for s in sets])
        self.links: list[tuple[int, int]] = []
        self.unlike: set[tuple[int, int]] = set()

    def compare(self, x: int, y: int) -> None:
        pair = (min(x, y), max(x, y))
        if pair in self.unlike:
            return
        a, b = self.sets[x], self.sets[y]
        if alike(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b)):
            self.links.append(pair)
            self.parts[self.parts == self.parts[y]] = self.parts[x]
        else:
            self.unlike.add(pair)

    def join(self, key: int, members: np.ndarray) -> None:
        """Link the members of a key, by its tree, as far as they are in several parts."""
        if (self.parts[members] != self.parts[members[0]]).any():
            Tree(self, members, bitmap_bits(key)).join()


class Tree:
    """A signature tree over some of the sets."""

    def __init__(self, sets: Sets, members: np.ndarray, bits: int):
        # Near copies mostly share their smallest token, which brings them under one node.
        by = np.lexsort((sets.sizes[members], sets.first[members], sets.parts[members]))
        self.sets, self.leaves = sets, members[by]
        sizes = sets.sizes[self.leaves]
        maps = np.stack([bitmap(sets.sets[i], bits) for i in self.leaves])
        excess = sizes - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels = [(maps, excess, sizes, sizes)]
        while len(self.levels[-1][0]) > 1:
            maps, excess, low, high = self.levels[-1]
            starts = np.arange(0, len(maps), FAN)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, starts, axis=0),
                    np.maximum.reduceat(excess, starts),
                    np.minimum.reduceat(low, starts),
                    np.maximum.reduceat(high, starts),
                )
            )

    def join(self) -> None:
        self._descend(len(self.levels) - 1, 0, 0)

    def _one_part(self, level: int, x: int, y: int) -> bool:
        width = FAN**level
        of = self.sets.parts
        left, right = (self.leaves[i * width : (i + 1) * width] for i in (x, y))
        return bool((of[left] == of[left[0]]).all() and (of[right] == of[left[0]]).all())

    def _descend(self, level: int, x: int, y: int) -> None:
        if self._one_part(level, x, y):
            return
        if x != y and not can_overlap(*self.levels[level], x, y):
            return
        if level == 0:
            self.sets.compare(int(self.leaves[x]), int(self.leaves[y]))
            return
        last = len(self.levels[level - 1][0])
        left = range(x * FAN, min(last, (x + 1) * FAN))
        right = range(y * FAN, min(last, (y + 1) * FAN))
        if x == y:
            for i in left:
                self._descend(level - 1, i, i)
        for i in left:
            for j in right:
                if x != y or i < j:
                    self._descend(level - 1, i, j)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, set_id, n, keys) of every document; no set has a null set_id."""

    @F.pandas_udf("struct<set_id:bigint,n:bigint,keys:array<bigint>>")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                own = tokens_of(text)
                rows.append((set_id(own) if len(own) else 0, len(own), routing_keys(own)))
            yield pd.DataFrame(rows, columns=["set_id", "n", "keys"])

    once = compute.asNondeterministic()
    id_ = F.col("doc_id").cast("bigint").alias("doc_id")
    return docs.select(id_, row_key(), once("text").alias("s")).select(
        "doc_id",
        "row_key",
        F.when(F.col("s.n") > 0, F.col("s.set_id")).alias("set_id"),
        "s.n",
        "s.keys",
    )


def row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text")).alias("row_key")


def shared_keys(routes: DataFrame) -> DataFrame:
    """(key, lo) of keys with two or more sets; one key of those that have the same sets.

    ``lo`` is the smallest of the sets, which names the family.
    """
    mark = F.xxhash64("set_id")
    return (
        routes.groupBy("key")
        .agg(F.min("set_id").alias("lo"), F.bit_xor(mark).alias("all"))
        .filter(F.xxhash64("lo") != F.col("all"))
        .groupBy("lo", "all")
        .agg(F.min("key").alias("key"))
        .select("key", "lo")
    )


def token_sets(docs: DataFrame, entries: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set_id, tokens) of the wanted sets, from the text of one row of each."""
    rows = entries.join(wanted.distinct(), "set_id").select("set_id", "row_key")

    @F.pandas_udf("struct<again:bigint,tokens:binary>")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets = [tokens_of(t) for t in texts]
            yield pd.DataFrame(
                {"again": [set_id(s) for s in sets], "tokens": [s.tobytes() for s in sets]}
            )

    once = compute.asNondeterministic()
    maybe = mark_possible(docs.select(row_key(), "text"), rows, "row_key", "_maybe").filter("_maybe")
    # Rows that are equal are one row; row keys that clash are told apart by the set.
    return (
        maybe.groupBy("row_key", "text").agg(F.count("*").alias("_rows"))
        .join(rows, "row_key")
        .select("set_id", once("text").alias("s"))
        .filter("s.again = set_id")
        .groupBy("set_id")
        .agg(F.first("s.tokens").alias("tokens"))
    )


def family_links(spark: SparkSession, families: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) from the trees of families (lo, set_id, n, keys), many to a task."""
    tasks = part_count(spark, families.agg(F.sum("n")).first()[0] or 0, TASK_TOKENS)

    def descend(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, family in rows.sort_values(["lo", "set_id"]).groupby("lo", sort=False):
            names = family["set_id"].to_numpy()
            sets = Sets([np.frombuffer(t, dtype=np.uint64) for t in family["tokens"]], names)
            keys = family["keys"].to_numpy()
            at = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            flat = np.concatenate(keys)
            order = np.argsort(flat, kind="stable")
            values, starts = np.unique(flat[order], return_index=True)
            trees = np.split(at[order], starts[1:])
            for i in sorted(range(len(trees)), key=lambda i: (-len(trees[i]), values[i])):
                sets.join(int(values[i]), trees[i])
            found += [(names[a], names[b]) for a, b in sets.links]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    task = F.pmod(F.xxhash64("lo"), F.lit(tasks)).alias("task")
    return (
        families.select("lo", "set_id", "keys", task)
        .join(sets, "set_id")
        .groupBy("task")
        .applyInPandas(descend, "a bigint, b bigint")
    )


def tree_links(spark: SparkSession, trees: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) from the trees (key, p, q, set_id, n, part), many small ones to a task."""
    trees = staged(spark, trees, "trees")
    tasks = part_count(spark, trees.agg(F.sum("n")).first()[0] or 0, TASK_TOKENS)

    def descend(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "p", "q", "set_id"])
        found = []
        for (key, _, _), tree in rows.groupby(["key", "p", "q"], sort=False):
            own = [np.frombuffer(t, dtype=np.uint64) for t in tree["tokens"]]
            names = tree["set_id"].to_numpy()
            sets = Sets(own, tree["part"].to_numpy())
            sets.join(int(key), np.arange(len(names)))
            found += [(names[a], names[b]) for a, b in sets.links]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    task = F.pmod(F.xxhash64("key", "p", "q"), F.lit(tasks)).alias("task")
    return (
        trees.select("key", "p", "q", "set_id", "part", task)
        .join(sets, "set_id")
        .groupBy("task")
        .applyInPandas(descend, "a bigint, b bigint")
    )


def _blocks(sets: str, tokens: str) -> Column:
    return F.ceil(F.greatest(F.col(sets) / SETS, F.col(tokens) / TOKENS)).cast("bigint")


def home_trees(members: DataFrame) -> DataFrame:
    """Each set under its fullest key; full keys are cut into blocks."""
    sized = members.groupBy("key").agg(F.count("*").alias("m"), F.sum("n").alias("t"))
    home = (
        members.join(sized, "key")
        .groupBy("set_id", "n")
        .agg(F.max(F.struct("m", "key", "t")).alias("best"))
        .select("set_id", "n", "best.*")
    )
    block = F.pmod(F.xxhash64("set_id"), _blocks("m", "t"))
    return home.select(
        "key", block.alias("p"), block.alias("q"), "set_id", "n", F.col("set_id").alias("part")
    )


def open_members(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members with their part, of the keys that hold more than one part."""
    named = members.join(parts.toDF("set_id", "part"), "set_id", "left").withColumn(
        "part", F.coalesce("part", "set_id")
    )
    open_ = named.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
    return named.join(open_.filter("lo <> hi").select("key"), "key")


def placed_in_blocks(members: DataFrame) -> DataFrame:
    """Members with a block of their key: large parts have their own, small ones share."""
    by_part = members.groupBy("key", "part").agg(F.count("*").alias("m"), F.sum("n").alias("t"))
    by_part = by_part.withColumn("own", _blocks("m", "t"))
    small = F.col("own") == 1
    rest = by_part.groupBy("key").agg(
        F.sum(F.when(small, F.col("m"))).alias("m"), F.sum(F.when(small, F.col("t"))).alias("t")
    )
    rest = rest.select("key", F.coalesce(_blocks("m", "t"), F.lit(1)).alias("shared"))
    block = F.when(
        F.col("own") > 1, F.xxhash64("part", F.pmod(F.xxhash64("set_id"), F.col("own")))
    ).otherwise(F.pmod(F.xxhash64("part"), F.col("shared")))
    return (
        members.join(by_part.select("key", "part", "own"), ["key", "part"])
        .join(rest, "key")
        .select("key", "set_id", "n", "part", block.alias("block"))
    )


def block_nodes(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """The node above each block of the keys that have several."""
    several = placed.groupBy("key").agg(F.min("block").alias("x"), F.max("block").alias("y"))
    cut = placed.join(several.filter("x <> y").select("key"), "key")

    def node(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bits = bitmap_bits(int(group[0]))
        maps = [bitmap(np.frombuffer(t, dtype=np.uint64), bits) for t in rows["tokens"]]
        excess = max(n - int(np.bitwise_count(m).sum()) for n, m in zip(rows["n"], maps, strict=True))
        parts = rows["part"].unique()
        return pd.DataFrame(
            {
                "key": [group[0]], "block": [group[1]],
                "map": [np.bitwise_or.reduce(maps, axis=0).tobytes()],
                "excess": [excess], "low": [rows["n"].min()], "high": [rows["n"].max()],
                "part": pd.array([parts[0] if len(parts) == 1 else None], dtype="Int64"),
            }
        )

    kind = "key bigint, block bigint, map binary, excess bigint, low bigint, high bigint, part bigint"
    return cut.join(sets, "set_id").groupBy("key", "block").applyInPandas(node, kind)


def node_pairs(nodes: DataFrame) -> DataFrame:
    """(key, p, q) of the node pairs that may cover a link between different parts."""
    names = [c for c in nodes.columns if c != "key"]
    left = nodes.toDF("key", *[f"{c}_p" for c in names])
    right = nodes.toDF("key", *[f"{c}_q" for c in names])

    @F.pandas_udf("boolean")
    def possible(*sides: pd.Series) -> pd.Series:
        return pd.Series(
            [
                can_overlap([np.frombuffer(m, np.uint64) for m in r[:2]], r[2:4], r[4:6], r[6:8], 0, 1)
                for r in zip(*sides, strict=True)
            ],
            dtype=bool,
        )

    apart = ~F.coalesce(F.col("part_p") == F.col("part_q"), F.lit(False))
    near = (F.col("low_p") * 9 <= F.col("high_q") * 10) & (F.col("low_q") * 9 <= F.col("high_p") * 10)
    met = left.join(right, "key").filter((F.col("block_p") < F.col("block_q")) & apart & near)
    sides = [f"{c}_{s}" for c in ("map", "excess", "low", "high") for s in "pq"]
    return met.filter(possible(*sides)).select("key", F.col("block_p").alias("p"), F.col("block_q").alias("q"))


def open_trees(spark: SparkSession, members: DataFrame, sets: DataFrame) -> DataFrame:
    """The trees of round two: each block with several parts, and block pairs that pass."""
    placed = staged(spark, placed_in_blocks(members), "placed")
    mixed_blocks = (
        placed.groupBy("key", "block").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
        .filter("lo <> hi").select("key", F.col("block").alias("p"), F.col("block").alias("q"))
    )
    pairs = mixed_blocks.unionByName(node_pairs(staged(spark, block_nodes(placed, sets), "nodes")))
    sides = F.explode(F.array_distinct(F.array("p", "q"))).alias("block")
    return pairs.select("key", "p", "q", sides).join(placed, ["key", "block"]).select(
        "key", "p", "q", "set_id", "n", "part"
    )


def linked_parts(spark: SparkSession, docs: DataFrame, entries: DataFrame) -> DataFrame:
    """(node, component) of the distinct sets that are linked with others."""
    routes = entries.select("set_id", "n", F.explode("keys").alias("key"))
    keys = staged(spark, shared_keys(routes), "keys")
    maybe = mark_possible(routes, keys, "key", "_maybe").filter("_maybe")
    members = staged(spark, maybe.join(keys, "key").select("key", "lo", "set_id", "n"), "members")
    sets = staged(spark, token_sets(docs, entries, members.select("set_id")), "sets")
    grown = members.groupBy("lo", "set_id").agg(F.first("n").alias("n"))
    large = staged(spark, grown.groupBy("lo").agg(F.sum("n").alias("t")).filter(F.col("t") > FAMILY), "large")
    small = members.join(large, "lo", "left_anti")
    families = small.groupBy("lo", "set_id").agg(F.first("n").alias("n"), F.collect_list("key").alias("keys"))
    links = staged(spark, family_links(spark, staged(spark, families, "families"), sets), "links")
    rest = staged(spark, members.join(large, "lo", "left_semi"), "rest")
    if not rest.isEmpty():
        first = staged(spark, tree_links(spark, home_trees(rest), sets), "links")
        links = links.unionByName(first)
        open_ = staged(spark, open_members(rest, components(spark, links)), "open")
        if not open_.isEmpty():
            more = tree_links(spark, open_trees(spark, open_, sets), sets)
            links = links.unionByName(staged(spark, more, "links"))
    return components(spark, links)


def similarity_classes(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    bound_batches(spark)
    own = staged(spark, sketches(docs), "sketches")
    entries = staged(
        spark,
        own.filter("set_id is not null").groupBy("set_id").agg(
            F.min("doc_id").alias("least"), F.min(F.struct("row_key", "n", "keys")).alias("r")
        ).select("set_id", "least", "r.*"),
        "entries",
    )
    parts = linked_parts(spark, docs, entries)
    named = (
        entries.select("set_id", "least")
        .join(parts.toDF("set_id", "part"), "set_id", "left")
        .withColumn("part", F.coalesce("part", "set_id"))
    )
    smallest = named.groupBy("part").agg(F.min("least").alias("component_id"))
    classes = named.join(smallest, "part").select("set_id", "component_id")
    return own.join(classes, "set_id", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return similarity_classes(spark, docs)


ORACLE = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
  END) AS s
  FROM words
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * i >= 90 * (x.n + y.n - i)
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach (a, b) AS (
  SELECT DISTINCT a, a FROM both_ways
  UNION
  SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b
),
least AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.a = d.doc_id
"""
