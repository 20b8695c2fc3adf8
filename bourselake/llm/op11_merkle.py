"""A Merkle manifest of a dataset, and a recursive query that climbs it.

A leaf is the SHA-256 of a row. The leaves of a source are the bottom of its tree, in the
order of doc_id; three consecutive nodes make the next level's node, until one is left, the
subroot. The subroots, in the order of their sources, are the bottom of the top tree.

What is built is stored as node rows. A node row stands for a node ``HOPS`` levels above the
nodes it covers (at most 3^HOPS of them), holds the hashes of the levels between, and is
linked to its parent row: (tree, height, place) to (up_tree, up_height, up_place) with its
slot there. A row per single node would let the climb shuffle every leaf with all its
siblings once a level, about six times the text over all levels; with these rows a climb
takes a hop for ``HOPS`` levels.

``climb`` is a recursive common table expression. It starts with all leaves and goes from a
row to its parent; each hop appends the siblings of the levels it passes, left to right, and
folds the hash, which may be that of a tampered text, with them. It ends above the root, so
the rows whose link is null carry the whole proof and the folded root.

Near a root few rows are left and all leaves pass them. A row with more than ``SHARE``
leaves below is therefore stored in copies, and a leaf goes to one of them by the hash of its place: no
key of the climb has more than about that many leaves, also at the root.

Positions come from a range partitioning by (source, doc_id) and counts per partition, so a
source with a third of all rows is sorted, hashed and climbed by many tasks.

Defined cases: null columns count as ``-``; a null source is a source of its own, the
first; null ids come first in their source and are never tampered; rows with equal ids are
ordered by their hashes, so equal rows are interchangeable; a lone leaf is its subroot, a
lone source's subroot the root; other columns do not count; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.operators import ranking
from bourselake.session import staged

FAN, HOPS = 3, 5
SPAN = FAN**HOPS
#: Leaves that climb through one copy of a node row.
SHARE = 60_000
#: Bytes of a hash, and hex digits of a run of children.
BYTES, RUN = 32, 64 * FAN
TOP = -1
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
LINK = ["tree", "height", "place"]
LEVEL_LIMIT = "spark.sql.cteRecursionLevelLimit"
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def leaf_hash(text: Column) -> Column:
    """SHA-256 in hex of the row's fields, each with its byte count, ``-`` if null."""
    values = [F.col(c).cast("string") for c in FIELDS[:-1]] + [text]
    return F.sha2(
        F.concat(
            *[
                F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
                for v in values
            ]
        ),
        256,
    )


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf and folded: the hash with the tampered text where the id says so."""
    text = F.col("text").cast("string")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    return docs.select(
        "doc_id",
        "source",
        F.unhex(leaf_hash(text)).alias("leaf"),
        F.unhex(leaf_hash(tampered)).alias("folded"),
    )


def levels_until_one(nodes: Column) -> Column:
    """Levels above ``nodes`` nodes until one is left, at most HOPS."""
    steps = F.lit(HOPS)
    for k in reversed(range(HOPS)):
        steps = F.when(nodes <= FAN**k, k).otherwise(steps)
    return steps


def _next_level(nodes: Column) -> Column:
    """Hex of the parents of a hex string of nodes."""
    runs = F.sequence(F.lit(0), F.floor((F.length(nodes) - 1) / RUN).cast("int"))
    parent = F.transform(runs, lambda i: F.sha2(F.substring(nodes, i * RUN + 1, F.lit(RUN)), 256))
    return F.array_join(parent, "")


def node_rows(nodes: DataFrame) -> DataFrame:
    """The rows above (tree, n, position, hash, covers): ``n`` nodes of a tree at one height.

    ``levels`` holds, for each level passed, the width of its nodes in children and their
    hashes; ``hash`` is what the row stands for and ``covers`` its leaves. A group holds at
    most 3^HOPS nodes.
    """
    place = F.floor(F.col("position") / SPAN).cast("bigint")
    groups = nodes.groupBy("tree", "n", place.alias("place")).agg(
        F.sort_array(F.collect_list(F.struct("position", F.hex("hash").alias("h")))).alias("own"),
        F.sum("covers").alias("covers"),
    )
    steps = levels_until_one(F.col("n"))
    bottom = F.lower(F.array_join(F.transform("own", lambda x: x["h"]), ""))
    none = F.array().cast("array<struct<width:int,nodes:binary>>")
    climbed = F.aggregate(
        F.filter(F.sequence(F.lit(1), F.lit(HOPS)), lambda k: k <= F.col("_steps")),
        F.struct(F.col("_bottom").alias("now"), none.alias("levels")),
        lambda acc, k: F.struct(
            _next_level(acc["now"]).alias("now"),
            F.concat(
                acc["levels"],
                F.array(
                    F.struct(
                        F.pow(F.lit(FAN), k - 1).cast("int").alias("width"),
                        F.unhex(acc["now"]).alias("nodes"),
                    )
                ),
            ).alias("levels"),
        ),
    )
    return (
        groups.select("tree", "n", "place", "covers", bottom.alias("_bottom"), steps.alias("_steps"))
        .withColumn("_up", climbed)
        .select("tree", "n", "place", "covers", F.unhex("_up.now").alias("hash"), F.col("_up.levels").alias("levels"))
    )


def build_tree(spark: SparkSession, bottom: DataFrame, parents: DataFrame | None) -> DataFrame:
    """All node rows above (tree, n, position, hash, covers), linked to their parents.

    ``parents`` gives for each tree where its last row is linked to (tree, up_place,
    up_slot), null for the end. Each round is written and is 1/3^HOPS of the one before.
    """
    rows, now, height = None, bottom, 0
    while True:
        made = staged(spark, node_rows(now).withColumn("height", F.lit(height)), "nodes")
        rest = F.ceil(F.col("n") / SPAN).cast("bigint")
        linked = made.withColumn("_n", rest)
        if parents is None:
            above = linked.withColumn("up_place", F.lit(None).cast("bigint")).withColumn("up_slot", F.lit(None).cast("int"))
        else:
            above = linked.join(parents, "tree")
        last = F.col("_n") == 1
        end_tree = F.when(F.col("up_place").isNotNull(), F.lit(TOP))
        linked = above.select(
            *LINK,
            "covers",
            "hash",
            "levels",
            F.when(last, end_tree).otherwise(F.col("tree")).cast("bigint").alias("up_tree"),
            F.when(last, F.when(F.col("up_place").isNotNull(), 0)).otherwise(height + 1).alias("up_height"),
            F.when(last, F.col("up_place")).otherwise(F.floor(F.col("place") / SPAN)).cast("bigint").alias("up_place"),
            F.when(last, F.col("up_slot")).otherwise(F.col("place") % SPAN).cast("int").alias("up_slot"),
        )
        rows = linked if rows is None else rows.unionByName(linked)
        now = made.filter(F.col("n") > SPAN).select("tree", rest.alias("n"), F.col("place").alias("position"), "hash", "covers")
        if now.isEmpty():
            return rows
        height += 1


def with_shares(nodes: DataFrame) -> DataFrame:
    """Node rows in as many copies as their leaves need, with the number of their parent's."""
    copies = F.ceil(F.col("covers") / SHARE).cast("int")
    up = [f"up_{c}" for c in LINK]
    parents = nodes.select(*[F.col(c).alias(f"up_{c}") for c in LINK], copies.alias("up_shares"))
    shares = F.explode(F.sequence(F.lit(0), copies - 1)).alias("share")
    return nodes.join(parents, up, "left").select(*LINK, shares, "hash", "levels", *up, "up_slot", "up_shares")


def manifest(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaves with their place and the linked node rows of all trees."""
    placed = ranking.with_position(
        spark,
        leaves(docs).withColumn("_all", F.lit(0)),
        ["_all"],
        [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc(), F.col("folded").asc()],
    )
    placed = staged(spark, placed, "placed")
    counts = placed.groupBy("source").agg(F.min("position").alias("first"), F.count("*").alias("n"))
    sources = ranking.with_position(
        spark, counts.withColumn("_all", F.lit(0)), ["_all"], [F.col("source").asc_nulls_first()]
    )
    sources = staged(
        spark,
        sources.select(F.col("source").alias("_source"), "first", "n", (F.col("position") - 1).alias("tree")),
        "sources",
    )
    at = F.col("position") - F.col("first")
    own = staged(
        spark,
        placed.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select(
            "doc_id", "leaf", "folded", "tree", "n", at.alias("position")
        ),
        "leaves",
    )
    ends = sources.select(
        "tree",
        F.floor(F.col("tree") / SPAN).cast("bigint").alias("up_place"),
        (F.col("tree") % SPAN).cast("int").alias("up_slot"),
    )
    bottom = own.select("tree", "n", "position", F.col("leaf").alias("hash"), F.lit(1).cast("bigint").alias("covers"))
    below = build_tree(spark, bottom, ends)
    subroots = below.filter(F.col("up_tree") == TOP).select(
        F.lit(TOP).cast("bigint").alias("tree"),
        F.lit(sources.count()).alias("n"),
        F.col("tree").alias("position"),
        "hash",
        "covers",
    )
    top = build_tree(spark, staged(spark, subroots, "subroots"), None)
    linked = staged(spark, below.unionByName(top), "linked")
    return own, staged(spark, with_shares(linked), "manifest")


def climb_sql() -> str:
    """The recursive query over {leaves} and {nodes}."""
    return f"""
WITH RECURSIVE climb (doc_id, leaf, salt, subroot, root, state, tree, height, place, share, slot) AS (
  SELECT doc_id, leaf, xxhash64(tree, position), CAST(NULL AS binary), CAST(NULL AS binary),
         named_struct('folded', folded, 'proof', CAST('' AS binary)),
         tree, 0, position div {SPAN}, 0, CAST(position % {SPAN} AS int)
  FROM {{leaves}}
  UNION ALL
  SELECT c.doc_id, c.leaf, c.salt,
         CASE WHEN n.up_tree = {TOP} AND n.tree <> {TOP} THEN n.hash ELSE c.subroot END,
         CASE WHEN n.up_tree IS NULL THEN n.hash END,
         aggregate(n.levels, c.state, (s, l) -> named_struct(
           'folded', unhex(sha2(lower(hex(concat(
             substring(l.nodes, (c.slot div l.width - c.slot div l.width % {FAN}) * {BYTES} + 1,
                       c.slot div l.width % {FAN} * {BYTES}),
             s.folded,
             substring(l.nodes, (c.slot div l.width + 1) * {BYTES} + 1,
                       ({FAN - 1} - c.slot div l.width % {FAN}) * {BYTES})))), 256)),
           'proof', concat(s.proof,
             substring(l.nodes, (c.slot div l.width - c.slot div l.width % {FAN}) * {BYTES} + 1,
                       c.slot div l.width % {FAN} * {BYTES}),
             substring(l.nodes, (c.slot div l.width + 1) * {BYTES} + 1,
                       ({FAN - 1} - c.slot div l.width % {FAN}) * {BYTES})))),
         n.up_tree, n.up_height, n.up_place, CAST(pmod(c.salt, n.up_shares) AS int), n.up_slot
  FROM climb c JOIN {{nodes}} n
    ON c.tree = n.tree AND c.height = n.height AND c.place = n.place AND c.share = n.share
)
SELECT doc_id, lower(hex(leaf)) AS leaf, lower(hex(subroot)) AS subroot, lower(hex(root)) AS root,
       sha2(lower(hex(state.proof)), 256) AS proof_sha256,
       lower(hex(state.folded)) AS folded_root, state.folded = root AS verified
FROM climb WHERE tree IS NULL
"""


CLIMB = climb_sql()


def climb(spark: SparkSession, own: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each leaf with its proof and folded root, by the recursive query over the node rows.

    Spark's limit of a million rows in a recursion is lifted while the result is written; a
    climb has one hop for HOPS levels, far from the limit of a hundred.
    """
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return staged(spark, spark.sql(CLIMB, leaves=own, nodes=nodes), "proofs")
    finally:
        spark.conf.set(ROW_LIMIT, before)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    own, nodes = manifest(spark, docs)
    return climb(spark, own, nodes)


def _oracle() -> str:
    """Levels by a recursion over runs of three, proofs by one over levels; crc32 from its rule."""
    text = "CASE WHEN even THEN replace(text, chr(10), '') ELSE text END"
    field = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"

    def leaf(of: str) -> str:
        return "sha256(" + " || ".join(field.format(f"({c})") for c in [*FIELDS[:-1], of]) + ")"

    def tree(name: str, bottom: str) -> str:
        return f"""{name} (tree, level, position, h) AS (
  {bottom}
  UNION ALL
  SELECT tree, level + 1, position // {FAN}, sha256(string_agg(h, '' ORDER BY position))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}) WHERE n > 1
  GROUP BY tree, level, position // {FAN}
)"""

    def proof(name: str, nodes: str, start: str) -> str:
        return f"""{name} (doc_id, leaf, tree, level, position, folded, proof) AS (
  {start}
  UNION ALL
  SELECT p.doc_id, any_value(p.leaf), p.tree, p.level + 1, p.position // {FAN},
         sha256(string_agg(CASE WHEN n.position = p.position THEN p.folded ELSE n.h END, '' ORDER BY n.position)),
         any_value(p.proof) || coalesce(string_agg(n.h, '' ORDER BY n.position) FILTER (n.position <> p.position), '')
  FROM {name} p JOIN {nodes} n
    ON n.tree IS NOT DISTINCT FROM p.tree AND n.level = p.level AND n.position // {FAN} = p.position // {FAN}
  WHERE EXISTS (SELECT 1 FROM {nodes} u WHERE u.tree IS NOT DISTINCT FROM p.tree AND u.level > p.level)
  GROUP BY p.doc_id, p.tree, p.level, p.position
)"""

    steps = [f"t{k} AS (SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c FROM t{k - 1})" for k in range(1, 9)]
    return f"""
WITH RECURSIVE
t0 AS (SELECT i::BIGINT AS i, i::BIGINT AS c FROM range(256) r(i)),
{", ".join(steps)},
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM t8),
signed AS MATERIALIZED (
  SELECT d.*, coalesce(xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
           lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 2 = 0, false) AS even
  FROM documents d, crc
),
hashed AS MATERIALIZED (
  SELECT doc_id, source, {leaf("text")} AS leaf, {leaf(text)} AS folded,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS position
  FROM signed
),
{tree("levels", "SELECT source, 0, position, leaf FROM hashed")},
built AS MATERIALIZED (SELECT * FROM levels),
subroots AS MATERIALIZED (
  SELECT tree AS source, h, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS position
  FROM (SELECT tree, h, level, max(level) OVER (PARTITION BY tree) AS last FROM built) WHERE level = last
),
{tree("tops", "SELECT 0, 0, position, h FROM subroots")},
topped AS MATERIALIZED (SELECT * FROM tops),
{proof("below", "built", "SELECT doc_id, leaf, source, 0, position, folded, '' FROM hashed")},
done AS MATERIALIZED (
  SELECT b.*, s.h AS subroot, s.position AS place
  FROM below b JOIN subroots s ON s.source IS NOT DISTINCT FROM b.tree
  WHERE b.level = (SELECT max(level) FROM built u WHERE u.tree IS NOT DISTINCT FROM b.tree)
),
{proof("above", "topped", "SELECT doc_id, leaf, 0, 0, place, folded, proof FROM done")},
root AS (SELECT h FROM topped ORDER BY level DESC LIMIT 1)
SELECT a.doc_id, a.leaf, d.subroot, root.h AS root, sha256(a.proof) AS proof_sha256,
       a.folded AS folded_root, a.folded = root.h AS verified
FROM above a JOIN done d ON d.doc_id = a.doc_id, root
WHERE a.level = (SELECT max(level) FROM topped)
"""


ORACLE = _oracle()
