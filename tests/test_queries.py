"""Every registered query against its SQL oracle, on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as contract
from bourselake.workload.oracles import ORACLES
from bourselake.workload.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(
    not os.path.isdir(SF_DIR), reason="the given tables are not here"
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def rows_by_column_name(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted([tuple(str(row[i]) for i in order) for row in rows])


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    oracle = duck.execute(ORACLES[name])
    names = [column[0] for column in oracle.description]
    assert sorted(found.columns) == sorted(names)
    mine = rows_by_column_name(found.columns, found.collect())
    assert mine == rows_by_column_name(names, oracle.fetchall())
    assert mine


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_have_no_pair_joins_and_no_python(spark, name):
    """Plans of the result and of everything a query writes on its way."""
    plans, write = [], DataFrameWriter.parquet

    def seen(self, *args, **options):
        plans.append(self._df._jdf.queryExecution().toString())
        return write(self, *args, **options)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(DataFrameWriter, "parquet", seen)
        plans.append(QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString())
    plan = "\n".join(plans)
    for word in ("NestedLoop", "Cartesian", "BatchEvalPython", "ArrowEval", "MapInPandas"):
        assert word not in plan, word
