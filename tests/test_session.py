from types import SimpleNamespace

from bourselake import session


def fake(**conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, *default: conf.get(name)))


def test_scratch_lies_in_the_folder_the_cluster_names():
    named = fake(**{"spark.checkpoint.dir": "/shared/x/"})
    first = session.scratch_path(named, "lake")
    second = session.scratch_path(named, "lake")
    assert first.startswith("/shared/x/bourselake/lake-")
    assert first != second


def test_without_that_folder_scratch_lies_in_the_warehouse():
    path = session.scratch_path(fake(**{"spark.sql.warehouse.dir": "s3://w"}), "lake")
    assert path.startswith("s3://w/_scratch/bourselake/lake-")


def test_staged_tables_live_until_the_block_ends(spark):
    with session.staging(spark) as stage:
        rows = stage(spark.range(10), "ten")
        path = rows.inputFiles()[0]
        assert rows.count() == 10 and session.path_exists(spark, path)
    assert not session.path_exists(spark, path)
