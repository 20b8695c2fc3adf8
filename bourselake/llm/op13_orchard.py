"""Vector codes by product quantisation, each part assigned by Orchard's search.

A vector becomes integers floor(256 x) and is cut into equal consecutive parts. Every
part position has a codebook of at most 64 entries. For each entry of a codebook the other
entries are listed by their distance to it. A search starts at one entry and reads its
list; an entry that is nearer to the part (or as near, with a lower index) becomes the
current one and its own list is read from the start. Entries looked at are marked and not
measured again. As soon as the list is at entries more than twice as far from the current
entry as the part is, no entry ahead can be as near (triangle inequality), and the search
stops: the nearest entry is exact, all arithmetic is in integers.

Codebooks are small whatever the table holds (64 vectors), so the driver keeps them and
tasks get them with their code. A round is one scan: tasks assign their rows and send one
sum and count per part and entry.

Defined cases: rows whose vector is null or empty, or holds a null, NaN or infinite
component, are dropped; so are rows of another length than that of the smallest kept
vec_id. Null ids come last in the order, equal ids are ordered by their vectors. A length
that 16 does not divide is filled with zeros to the next multiple. Components beyond
2^25 (131,072 as a float) count as that bound. Fewer than 64 vectors make smaller
codebooks. Null labels are one label. No rows give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.session import staged

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE, BOUND = 256, 1 << 25
#: Vectors that are searched at once.
BLOCK = 4096


def usable(vector: Column) -> Column:
    """Vectors with components, all of them finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def kept_rows(rows: DataFrame) -> DataFrame:
    vector = F.col("embedding").cast("array<double>")
    return rows.select("vec_id", "label", vector.alias("embedding")).filter(usable(F.col("embedding")))


def integers(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """(rows, parts, components of a part) of vectors that have ``width`` components."""
    scaled = np.floor(np.stack(vectors).astype(np.float64) * SCALE)
    whole = np.clip(scaled, -BOUND, BOUND).astype(np.int64)
    per_part = math.ceil(width / PARTS)
    filled = np.pad(whole, ((0, 0), (0, per_part * PARTS - width)))
    return filled.reshape(len(filled), PARTS, per_part)


@dataclass(frozen=True)
class Book:
    """A codebook with its sorted neighbour lists; distances are squared."""

    entries: np.ndarray
    lists: np.ndarray
    apart: np.ndarray
    start: int

    @classmethod
    def of(cls, entries: np.ndarray) -> Book:
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        lists = np.argsort(apart, axis=1, kind="stable")
        middle = int(np.argmin(np.sqrt(apart.astype(np.float64)).sum(axis=1)))
        return cls(entries, lists, np.take_along_axis(apart, lists, axis=1), middle)


def search(book: Book, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (ties: the lowest index) and squared distance of every point.

    All points walk their lists side by side; those that have stopped drop out.
    """
    n, size = len(points), len(book.entries)
    current = np.full(n, book.start)
    best = ((points - book.entries[book.start]) ** 2).sum(axis=1)
    marked = np.zeros((n, size), dtype=bool)
    marked[:, book.start] = True
    place = np.zeros(n, dtype=np.int64)
    active = np.arange(n)
    while len(active):
        here, at = current[active], place[active]
        # Roots of squares: farther than twice as far is more than four times the square.
        ahead = at < size
        ahead[ahead] = book.apart[here[ahead], at[ahead]] <= 4 * best[active[ahead]]
        active, here, at = active[ahead], here[ahead], at[ahead]
        if not len(active):
            break
        entry = book.lists[here, at]
        place[active] += 1
        new = ~marked[active, entry]
        active_new, entry = active[new], entry[new]
        marked[active_new, entry] = True
        far = ((points[active_new] - book.entries[entry]) ** 2).sum(axis=1)
        nearer = (far < best[active_new]) | (
            (far == best[active_new]) & (entry < current[active_new])
        )
        moved = active_new[nearer]
        best[moved], current[moved], place[moved] = far[nearer], entry[nearer], 0
    return current, best


def assign(books: list[Book], points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, parts) entry numbers and squared distances."""
    codes = np.empty(points.shape[:2], dtype=np.int64)
    errors = np.empty(points.shape[:2], dtype=np.int64)
    for part, book in enumerate(books):
        codes[:, part], errors[:, part] = search(book, points[:, part])
    return codes, errors


def _blocks(batch: pd.DataFrame, width: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    fitting = batch[batch["embedding"].map(len) == width]
    for start in range(0, len(fitting), BLOCK):
        block = fitting.iloc[start : start + BLOCK]
        yield block, integers(list(block["embedding"]), width)


def first_books(kept: DataFrame) -> tuple[list[Book], int]:
    """Codebooks of the smallest ids and the length of the vectors."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding").asc()]
    first = kept.orderBy(*order).limit(1).select(F.size("embedding")).first()
    if first is None:
        return [], 0
    width = first[0]
    smallest = kept.filter(F.size("embedding") == width).orderBy(*order).limit(ENTRIES)
    points = integers([np.array(r["embedding"]) for r in smallest.collect()], width)
    return [Book.of(points[:, part]) for part in range(PARTS)], width


def next_books(kept: DataFrame, books: list[Book], width: int) -> list[Book]:
    """Each entry moves to the floored mean of its parts; entries without any stay."""

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((PARTS, *books[0].entries.shape), dtype=np.int64)
        counts = np.zeros(sums.shape[:2], dtype=np.int64)
        for batch in batches:
            for _, points in _blocks(batch, width):
                codes, _ = assign(books, points)
                for part in range(PARTS):
                    np.add.at(sums[part], codes[:, part], points[:, part])
                    counts[part] += np.bincount(codes[:, part], minlength=sums.shape[1])
        part, entry = np.nonzero(counts)
        yield pd.DataFrame(
            {
                "part": np.repeat(part, sums.shape[2]),
                "entry": np.repeat(entry, sums.shape[2]),
                "position": np.tile(np.arange(sums.shape[2]), len(part)),
                "total": sums[part, entry].reshape(-1),
                "n": np.repeat(counts[part, entry], sums.shape[2]),
            }
        )

    kind = "part int, entry int, position int, total bigint, n bigint"
    found = (
        kept.select("embedding").mapInPandas(totals, kind).groupBy("part", "entry", "position")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )
    entries = np.stack([b.entries for b in books])
    # One row per component of a codebook, whatever the table holds.
    for r in found.collect():
        entries[r["part"], r["entry"], r["position"]] = r["total"] // r["n"]
    return [Book.of(entries[part]) for part in range(PARTS)]


def encode(kept: DataFrame, books: list[Book], width: int) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and squared error of every row."""
    label_kind = kept.schema["label"].dataType.simpleString()
    id_kind = kept.schema["vec_id"].dataType.simpleString()

    def codes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for vectors in batches:
            batch = pd.DataFrame({"embedding": vectors})
            out = pd.DataFrame({"code": [None] * len(batch), "error": 0}, index=batch.index)
            for block, points in _blocks(batch, width):
                found, errors = assign(books, points)
                out.loc[block.index, "code"] = [bytes(c.astype(np.uint8)).hex() for c in found]
                out.loc[block.index, "error"] = errors.sum(axis=1)
            yield out

    once = F.pandas_udf(codes, "struct<code:string,error:bigint>").asNondeterministic()
    return (
        kept.select(
            F.col("vec_id").cast(id_kind), F.col("label").cast(label_kind), once("embedding").alias("r")
        )
        .select("vec_id", "label", "r.code", "r.error")
        .filter("code is not null")
    )


def train(kept: DataFrame, rounds: int = ROUNDS) -> tuple[list[Book], int]:
    books, width = first_books(kept)
    for _ in range(rounds if books else 0):
        books = next_books(kept, books, width)
    return books, width


def digest(books: list[Book]) -> str:
    numbers = ",".join(str(x) for b in books for x in b.entries.reshape(-1).tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def query(spark: SparkSession, rows: DataFrame) -> DataFrame:
    kept = kept_rows(rows)
    books, width = train(kept)
    coded = staged(spark, encode(kept, books, width), "codes") if books else (
        kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
    )
    # Null labels group together; the sums meet the rows by a null-safe key.
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def _oracle() -> str:
    """The same codes by measuring every entry."""

    def assigned(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (
  SELECT vec_id, part, min(struct_pack(d := d, entry := entry)) AS best FROM (
    SELECT c.vec_id, c.part, b.entry, sum((c.x - b.y) * (c.x - b.y))::BIGINT AS d
    FROM comps c JOIN b{n} b ON b.part = c.part AND b.position = c.position
    GROUP BY c.vec_id, c.part, b.entry
  ) GROUP BY vec_id, part
)"""

    def moved(n: int) -> str:
        return f"""b{n + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.position, coalesce(m.y, b.y) AS y
  FROM b{n} b LEFT JOIN (
    SELECT c.part, a.best.entry AS entry, c.position, floor(sum(c.x)::DOUBLE / count(*))::BIGINT AS y
    FROM comps c JOIN a{n} a ON a.vec_id = c.vec_id AND a.part = c.part
    GROUP BY c.part, a.best.entry, c.position
  ) m ON m.part = b.part AND m.entry = b.entry AND m.position = b.position
)"""

    steps = [s for n in range(ROUNDS) for s in (assigned(n), moved(n))] + [assigned(ROUNDS)]
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
long AS (
  SELECT vec_id, len(embedding) // {PARTS} AS w, unnest(range(len(embedding))) AS i, unnest(embedding) AS x
  FROM kept
),
comps AS MATERIALIZED (
  SELECT vec_id, i // w AS part, i % w AS position, floor({SCALE} * x::DOUBLE)::BIGINT AS x FROM long
),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept),
b0 AS MATERIALIZED (
  SELECT c.part, f.entry, c.position, c.x AS y FROM comps c JOIN first f USING (vec_id) WHERE f.entry < {ENTRIES}
),
{", ".join(steps)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code,
         sum(best.d)::BIGINT AS error
  FROM a{ROUNDS} GROUP BY vec_id
),
book AS (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY part, entry, position)) AS h FROM b{ROUNDS})
SELECT vec_id, code, error,
       sum(error) OVER (PARTITION BY k.label)::BIGINT AS label_error,
       book.h AS codebooks_sha256
FROM coded JOIN kept k USING (vec_id), book
"""


ORACLE = _oracle()
