"""File discovery.

Raw and bronze folders hold one entry per table whose name ends in
``.csv`` (any case): a CSV file, or a folder of CSV part files. The table
name is the entry's stem. The driver lists one level, the entries; tasks list
what lies below, level by level (names, sizes and times, no content), and the
listing is a DataFrame, so the driver never holds the file names.

Lake layers hold one Parquet folder per table; ``lake_tables`` lists the
folder names one level down through the Hadoop FileSystem of the path (a
metadata call, independent of how many part files the tables have).
"""

from __future__ import annotations

import fnmatch
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import written_once
from strata.sources.stores import children, store_settings

# The listing runs in Python workers: shipped by value (see ``stores``).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CSV_GLOB = "*.[cC][sS][vV]"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` fully qualified by its Hadoop FileSystem (scheme and
    authority added), the form the file index reports paths in."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).makeQualified(p).toString().rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its Hadoop FileSystem (a metadata call)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


LISTING_SCHEMA = "path string, length long, modificationTime timestamp"


def _entries(spark: SparkSession, root: str) -> list[str]:
    """Paths directly under ``root`` (one a table)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(f"no such folder: {root}")
    if not fs.getFileStatus(p).isDirectory():
        return [p.toString()]
    found = (s.getPath() for s in fs.listStatus(p))
    return [f.toString() for f in found if not f.getName().startswith(("_", "."))]


_LEVEL_SCHEMA = f"{LISTING_SCHEMA}, is_folder boolean"


def _lister(settings: dict):
    """Lists one level of each folder it is given."""

    def level(batches):
        for pdf in batches:
            for path in pdf["path"]:
                rows = [(p, size, time, folder) for p, folder, size, time in children(path, settings)]
                for at in range(0, len(rows), 10_000):
                    yield pd.DataFrame(rows[at : at + 10_000], columns=["path", "length", "modificationTime", "is_folder"]).astype(
                        {"length": "Int64"}
                    )

    return level


def list_files(spark: SparkSession, root: str, glob: str = CSV_GLOB) -> DataFrame:
    """All files matching ``glob`` under ``root`` (any depth; names that begin
    with ``_`` or ``.`` hidden): ``path, length, modificationTime``. No content is
    read.

    The folders are walked level by level: a job lists one level, its folders
    dealt over all tasks anew, so neither one deep entry nor one with many folders
    is a single task's work; a task holds the names of one folder at a time. Every
    level is written once, and only how many folders are left reaches the driver.
    """
    entries = _entries(spark, root)
    settings, most = store_settings(spark), 4 * max(spark.sparkContext.defaultParallelism, 2)
    frontier, left = spark.createDataFrame([(e,) for e in entries], "path string"), len(entries)
    found = spark.createDataFrame([], LISTING_SCHEMA)
    while left:
        dealt = frontier.repartition(max(1, min(left, most)), "path")
        level = written_once(dealt.mapInPandas(_lister(settings), _LEVEL_SCHEMA), "listing")
        found = found.unionAll(level.where("not is_folder").drop("is_folder"))
        frontier = level.where("is_folder").select("path")
        left = frontier.count()
    name = F.element_at(F.split("path", "/"), -1)
    return found.where(_matches(name, glob))


def _matches(name: Column, glob: str) -> Column:
    """Whether a file name matches a glob (the whole name, case-sensitive)."""
    return name.rlike(r"\A(?:" + fnmatch.translate(glob).removesuffix(r"\z").removesuffix(r"\Z") + r")\z")


def with_table(files: DataFrame, root_q: str, path_col: str = "path") -> DataFrame:
    """Add ``entry`` (the file or folder directly under ``root_q`` that
    holds the file) and ``table`` (that entry's name without ``.csv``);
    files outside a ``*.csv`` entry are dropped."""
    first = F.split(F.substring(F.col(path_col), len(root_q) + 2, 1 << 30), "/").getItem(0)
    return (
        files.withColumn("entry", F.concat(F.lit(root_q + "/"), first))
        .withColumn("table", F.regexp_extract(first, r"^(.+)\.[cC][sS][vV]$", 1))
        .where(F.col("table") != "")
    )


def csv_manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row per CSV table under ``root``: ``table, entry, files,
    bytes, size_mb``, sorted by table name.

    ``entry`` is the path of the table's file or folder directly under
    ``root``. Raises ``FileNotFoundError`` when there is no CSV.
    """
    root_q = qualified(spark, root)
    manifest = (
        with_table(list_files(spark, root_q), root_q)
        .groupBy("table", "entry")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        .withColumn("size_mb", F.round(F.col("bytes") / F.lit(1e6), 2))
        .orderBy("table", "entry")
    )
    if manifest.isEmpty():
        raise FileNotFoundError(f"no CSV found in {root}")
    return manifest


def lake_tables(spark: SparkSession, layer: str) -> list[str]:
    """S3: names of the table folders directly under a layer, sorted;
    hidden (``_``/``.``) names skipped; a missing layer has no table."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(layer)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    names = [
        s.getPath().getName()
        for s in fs.listStatus(path)
        if s.isDirectory() and not s.getPath().getName().startswith(("_", "."))
    ]
    return sorted(n for n in names if n)


def lake_tables_frame(spark: SparkSession, layer: str) -> DataFrame:
    """``lake_tables`` as a one-column DataFrame (``table``)."""
    return spark.createDataFrame([(n,) for n in lake_tables(spark, layer)], "table string")
