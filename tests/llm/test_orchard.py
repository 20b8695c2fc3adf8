"""Vector codes against measuring every entry."""

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from bourselake.llm import op13_orchard
from tests.llm.fixtures import SF, needs_tables


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 64), st.integers(1, 5), st.integers(1, 40), st.integers(0, 2**32))
def test_search_finds_the_lowest_of_the_nearest_entries(entries, width, spread, seed):
    """Small ranges make many ties and equal entries."""
    draw = np.random.default_rng(seed)
    book = op13_orchard.Book.of(draw.integers(-spread, spread + 1, (entries, width)))
    points = draw.integers(-2 * spread, 2 * spread + 1, (50, width))
    far = ((points[:, None, :] - book.entries[None]) ** 2).sum(axis=2)
    found, errors = op13_orchard.search(book, points)
    assert (found == far.argmin(axis=1)).all() and (errors == far.min(axis=1)).all()


def test_most_entries_are_never_measured():
    draw = np.random.default_rng(1)
    book = op13_orchard.Book.of(draw.integers(-1000, 1000, (64, 2)))
    points = book.entries + draw.integers(-3, 4, (64, 2))
    looked = []

    class Counting:
        def __len__(self):
            return len(book.entries)

        def __getitem__(self, key):
            looked.append(len(key) if isinstance(key, np.ndarray) else 1)
            return book.entries[key]

    counted = op13_orchard.Book(Counting(), book.lists, book.apart, book.start)
    op13_orchard.search(counted, points)
    assert sum(looked) < 0.5 * 64 * 64


def test_rounds_move_entries_to_floored_means_and_leave_unused_ones(spark):
    rows = [(i, [x / 256] * 16, 0) for i, x in enumerate([0, 0, 100, 0, 3, -1, 99])]
    table = op13_orchard.kept_rows(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"))
    books, width = op13_orchard.first_books(table)
    assert width == 16 and [e[0] for e in books[0].entries] == [0, 0, 100, 0, 3, -1, 99]
    moved = op13_orchard.next_books(table, books, width)
    assert [e[0] for e in moved[7].entries] == [0, 0, 100, 0, 3, -1, 99]
    fewer = [op13_orchard.Book.of(np.array([[0], [98], [500]])) for _ in range(16)]
    assert [e[0] for e in op13_orchard.next_books(table, fewer, width)[0].entries] == [0, 99, 500]


@needs_tables
def test_oracle_on_the_smallest_table(spark):
    found = op13_orchard.query(spark, spark.read.parquet(f"{SF}/embeddings.parquet")).collect()
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
        assert sorted(map(tuple, found)) == sorted(duck.execute(op13_orchard.ORACLE).fetchall())
