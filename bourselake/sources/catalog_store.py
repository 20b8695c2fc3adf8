"""Where the catalog is kept: versions of one table, and imported entry files.

A table is a whole version and the changes since. A change holds the keys it touched, each
with all its rows; of several changes of a key the latest counts. Versions and changes are
numbered in one sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourselake.functions import symbols
from bourselake.session import drop_path

RANGES = T.ArrayType(
    T.StructType([T.StructField("start", T.DateType()), T.StructField("end", T.DateType())])
)
ISSUES = T.ArrayType(
    T.StructType(
        [
            T.StructField("date", T.DateType()),
            T.StructField("issue_type", T.StringType()),
            T.StructField("message", T.StringType()),
        ]
    )
)
SPECS = T.StructType(
    [
        T.StructField("multiplier", T.DoubleType()),
        T.StructField("tick_size", T.DoubleType()),
        T.StructField("currency", T.StringType()),
    ]
)
ENTRY_FILE = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("stype", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("ranges", RANGES),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("cache_version", T.IntegerType()),
        T.StructField("contract_specs", SPECS),
        T.StructField("quality_issues", ISSUES),
    ]
)


def read_entry_files(spark: SparkSession, root: str) -> DataFrame:
    """Import per-key JSON catalog entries found anywhere under ``root``."""
    return (
        spark.read.schema(ENTRY_FILE)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(root)
        .withColumnRenamed("schema", "schema_")
    )


def write_entry_files(entries: DataFrame, root: str) -> None:
    """Export entries, one row per key with its nested ranges, as one JSON file per key.

    Files are indented, so they span lines, and lie in folders of dataset, symbol and
    schema; what is in a file tells its key, too.
    """
    folders = {
        "in_dataset": F.col("dataset"),
        "in_symbol": symbols.path_symbol(F.col("symbol")),
        "in_schema": F.col("schema_"),
    }
    (
        entries.withColumns(folders)
        .withColumnRenamed("schema_", "schema")
        .write.partitionBy(*folders)
        .option("pretty", True)
        .json(root)
    )


#: Changes are folded into a whole version once they hold this share of its bytes and more
#: than the least bytes, or are this many.
COMPACT_SHARE, COMPACT_LEAST, COMPACT_COUNT = 0.25, 64 << 20, 64


def _files(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def _numbers(spark: SparkSession, path: str, kind: str, finished: bool = True) -> list[int]:
    """Numbers of the versions or changes, in order; by default of finished writes only."""
    files, root = _files(spark, path)
    pattern = f"{kind}=*/_SUCCESS" if finished else f"{kind}=*"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    found = [f.getPath() for f in files.globStatus(hadoop.Path(root, pattern))]
    names = [(p.getParent() if finished else p).getName() for p in found]
    return sorted(int(n.split("=")[1]) for n in names)


def _next_number(spark: SparkSession, path: str) -> int:
    taken = [n for kind in ("version", "change") for n in _numbers(spark, path, kind, False)]
    return max(taken, default=0) + 1


def _changes(spark: SparkSession, path: str) -> list[int]:
    """Changes not yet in the current version.

    One with the version's own number was made beside it by another writer, so it counts.
    """
    since = max(_numbers(spark, path, "version"), default=0)
    return [n for n in _numbers(spark, path, "change") if n >= since]


def save_catalog(spark: SparkSession, catalog: DataFrame, path: str) -> int:
    """Write the catalog as the next version; readers see it once it is whole.

    The new version may be computed from the current one, which stays readable. Of two
    writers that take the same number the later one fails. Versions before the current
    one, and the changes they took, are dropped once the new one is whole.
    """
    done = _numbers(spark, path, "version")
    version = _next_number(spark, path)
    catalog.write.mode("errorifexists").parquet(f"{path}/version={version}")
    kept = done[-1] if done else 0
    for kind in ("version", "change"):
        for old in _numbers(spark, path, kind):
            if old < kept:
                drop_path(spark, f"{path}/{kind}={old}")
    return version


def append_changes(
    spark: SparkSession, rows: DataFrame, touched: DataFrame, path: str, keys: list[str]
) -> int:
    """Replace all rows of the ``touched`` keys by ``rows``, writing no other key.

    ``rows`` are those of touched keys; others are ignored. A touched key without rows is
    deleted. A key's rows are stored as one array, so a key must have boundedly many, as
    the ranges and masks of a calendar have. Both tables may be computed from the stored
    one.
    """
    number = _next_number(spark, path)
    rest = [c for c in rows.columns if c not in keys]
    kind = T.ArrayType(T.StructType([rows.schema[c] for c in rest]))
    listed = rows.groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias("rows"))
    (
        touched.select(*keys)
        .distinct()
        .join(listed, keys, "left")
        .select(*keys, F.coalesce("rows", F.array().cast(kind)).alias("rows"))
        .write.mode("errorifexists")
        .parquet(f"{path}/change={number}")
    )
    compact(spark, path)
    return number


def compact(
    spark: SparkSession,
    path: str,
    share: float = COMPACT_SHARE,
    least: int = COMPACT_LEAST,
    count: int = COMPACT_COUNT,
) -> bool:
    """Write a whole version if the changes have grown beyond the share or count."""
    changes, versions = _changes(spark, path), _numbers(spark, path, "version")
    if not changes:
        return False
    files, _ = _files(spark, path)

    def size(folder: str) -> int:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        return files.getContentSummary(place).getLength()

    changed = sum(size(f"change={n}") for n in changes)
    whole = size(f"version={versions[-1]}") if versions else 0
    if len(changes) < count and changed <= max(share * whole, least):
        return False
    save_catalog(spark, load_catalog(spark, path), path)
    return True


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the current version, those of changed keys from their latest change."""
    versions, changes = _numbers(spark, path, "version"), _changes(spark, path)
    if not versions and not changes:
        raise FileNotFoundError(f"no finished catalog version under {path}")
    whole = spark.read.parquet(f"{path}/version={versions[-1]}") if versions else None
    if not changes:
        return whole
    folders = [f"{path}/change={n}" for n in changes]
    changed = spark.read.option("basePath", path).parquet(*folders)
    keys = [c for c in changed.columns if c not in ("rows", "change")]
    latest = changed.groupBy(*keys).agg(F.max_by("rows", "change").alias("rows"))
    new = latest.select(*keys, F.inline("rows"))
    if whole is None:
        return new
    same = whole.join(latest.select(*keys), keys, "left_anti").select(*whole.columns)
    return same.unionByName(new)
