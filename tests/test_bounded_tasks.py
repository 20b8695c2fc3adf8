"""Steps whose tasks or rows grew with the input: what their plans must not do."""

from bourselake.functions import daymask
from bourselake.operators import coverage, intervals
from bourselake.plans import updates
from bourselake.session import spread
from bourselake.workload import views
from pyspark.sql import functions as F
from tests.conftest import KEYED, d, ranges, tick_rows

KEY = coverage.KEY


def tasks(rows):
    return rows.rdd.getNumPartitions()


def fine(spark):
    return 8 * spark.sparkContext.defaultParallelism


def test_tables_dealt_by_key_are_not_merged_into_few_tasks(spark):
    given = ranges(spark, [("2024-01-01", "2024-01-05"), ("2024-01-04", "2024-02-02")])
    assert tasks(spread(given, *KEY)) >= fine(spark)
    assert tasks(intervals.merge_ranges(given, KEY)) >= fine(spark)
    assert tasks(intervals.ranges_to_months(given, KEY)) >= fine(spark)
    days = given.withColumn("trade_date", F.col("range_start"))
    assert tasks(intervals.month_islands(days, KEY, "trade_date")) >= fine(spark)


def test_rolls_are_dealt_by_key(spark, contract):
    held = ranges(spark, [("2024-01-01", "2024-02-01")], ("GLBX.MDP3", "ESH24", "ohlcv-1d"))
    assert tasks(updates.auto_roll_plan(held, contract, d("2024-06-01"), ["dataset"])) >= fine(spark)


def test_a_successor_under_a_null_key_rolls(spark, contract):
    rows = [(None, "ESH24", "ohlcv-1d", d("2024-01-01"), d("2024-03-15")),
            (None, "ESM24", "ohlcv-1d", d("2024-03-01"), d("2024-03-20"))]
    held = spark.createDataFrame(rows, KEYED + "range_start date, range_end date")
    found = updates.auto_roll_plan(held, contract, d("2024-04-01"), ["dataset"]).collect()
    assert [r.symbol for r in found] == ["ESM24"]


def test_long_windows_are_not_cut_into_months_to_find_rows(spark):
    asked = ranges(spark, [("2015-01-01", "2021-12-31"), ("2030-01-01", "2030-12-31")])
    days = coverage.present_days(tick_rows(spark, [("GLBX.MDP3", "ES.c.0", "ohlcv-1d", "2018-02-03", 1)]))
    found = coverage.empty_requests(asked, days)
    assert "explode" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [str(r.range_start) for r in found.collect()] == ["2030-01-01"]


def test_gaps_of_months_in_part_and_of_whole_months_join(spark, calendar):
    key = ("GLBX.MDP3", "ES.c.0", "ohlcv-1d")
    asked = ranges(spark, [("2023-11-10", "2024-03-20")], key)
    rows = tick_rows(spark, [(*key, "2024-01-10", 1)])
    recorded = ranges(spark, [("2024-01-05", "2024-01-09"), ("2024-01-20", "2024-01-25")], key)
    split = updates.ensure_split(asked, recorded, coverage.present_partitions(rows), calendar)
    assert sorted((str(r.gap_start), str(r.gap_end)) for r in split.collect()) == [
        ("2023-11-10", "2024-01-04"), ("2024-01-10", "2024-01-19"), ("2024-01-26", "2024-03-20"),
    ]


def test_runs_of_a_mask(spark):
    masks = {0: [], 1: [(1, 1)], 0b1011: [(1, 2), (4, 4)], 0b10101: [(1, 1), (3, 3), (5, 5)],
             (1 << 31) - 1: [(1, 31)]}
    rows = spark.createDataFrame([(m,) for m in masks], "m bigint")
    for r in rows.select("m", daymask.runs_in(F.col("m")).alias("runs")).collect():
        assert [tuple(x) for x in r.runs] == masks[r.m]


def batch(spark, contract, calendar, spans, recorded, present):
    columns = "dataset string, root string, schema_ string, from_year int, to_year int"
    asked = spark.createDataFrame(spans, columns)
    return updates.batch_plan(asked, contract, recorded, present, calendar, d("2024-08-01"), ["dataset"])


def test_batches_are_listed_after_the_last_grouping(spark, contract, calendar):
    recorded = ranges(spark, [("2024-03-01", "2024-03-31")], ("GLBX.MDP3", "NQM24", "ohlcv-1d"))
    present = coverage.present_partitions(tick_rows(spark, [("GLBX.MDP3", "NQM24", "ohlcv-1d", "2024-03-08", 1)]))
    planned = batch(spark, contract, calendar, [("GLBX.MDP3", "NQ", "ohlcv-1d", 2015, 2024)], recorded, present)
    plan = planned._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index(">= from_year")]
    assert "Aggregate" not in above and "Repartition" not in above


def test_batches_agree_with_the_status_of_their_requests(spark, contract, calendar):
    spans = [("GLBX.MDP3", "NQ", "ohlcv-1d", 2020, 2021), ("GLBX.MDP3", "nq", "ohlcv-1d", 2021, 2021),
             ("GLBX.MDP3", "NQ", "ohlcv-1d", 2024, 2024), ("GLBX.MDP3", "NQ", "trades", 2024, 2030),
             ("XNAS.ITCH", "ES", "trades", 2024, 2024), (None, "ES", "trades", 2024, 2024),
             ("XNAS.ITCH", "ES", "trades", None, 2024), ("XNAS.ITCH", "ES", "trades", 2025, 2024)]
    days = ["2024-03-08", "2024-03-11", "2024-04-30", "2024-05-01", "2024-06-03", "2020-12-31"]
    keys = [(s, y, sc) for s, y in (("GLBX.MDP3", "NQM24"), ("GLBX.MDP3", "NQH21"), ("XNAS.ITCH", "ESM24"), (None, "ESM24"))
            for sc in ("ohlcv-1d", "trades")]
    present = coverage.present_partitions(tick_rows(spark, [(*k, x, 1) for k in keys for x in days]))
    parts = [("2024-03-01", "2024-03-15"), ("2024-03-14", "2024-03-31"), ("2024-04-02", "2024-06-30"), ("2020-12-10", "2021-01-02")]
    rows = [(*k, d(a), d(b)) for k in keys for a, b in parts]
    recorded = spark.createDataFrame(rows, KEYED + "range_start date, range_end date")
    masks = coverage.recorded_buckets(recorded)
    columns = "dataset string, root string, schema_ string, from_year int, to_year int"
    wanted = updates.available_contracts(spark.createDataFrame(spans, columns), contract, d("2024-08-01"))
    asked = wanted.withColumnsRenamed({"window_start": "range_start", "window_end": "range_end"})
    for known in (recorded, masks, None):
        want = coverage.coverage_status(asked, known, present, calendar)
        got = batch(spark, contract, calendar, spans, known, present).drop("action")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_updates_and_holdings_are_dealt_before_they_are_grouped(spark, contract, tmp_path):
    held = ranges(spark, [("2024-01-01", "2024-02-01")], ("GLBX.MDP3", "ESH24", "ohlcv-1d"))
    ends = updates.available_end(held.withColumn("trade_date", F.col("range_end")))
    assert tasks(updates.update_plan(held, ends, contract, d("2024-06-01"))) >= fine(spark)
    bars = [(1, 1, 1, 5.0, 0.1, "A", "F", d("1996-01-10")), (1, 1, 2, 7.0, 0.0, "A", "F", d("1996-03-04"))]
    columns = "l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double, "
    lines = spark.createDataFrame(bars, columns + "l_returnflag string, l_linestatus string, l_shipdate date")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    holdings = views.holdings(spark, str(tmp_path))
    assert tasks(holdings) >= fine(spark)
    assert sorted((r.symbol, str(r.range_start), str(r.range_end), r.size_bytes, r.n_issues) for r in holdings.collect()) == [
        ("ESH16", "2016-01-01", "2016-03-18", 12, 1), ("ESM16", "2016-03-04", "2016-03-31", 7, 0),
    ]
