"""Lake scans and SQL over registered views."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, layer: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a layer folder."""
    return spark.read.parquet(f"{layer.rstrip('/')}/{name}")


def warehouse_sql(spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run one SQL text; a view of ``views`` is written ``{name}`` in the
    text and stands for that frame in this statement only (no view of the
    session is added or replaced). The text goes through Catalyst like any
    DataFrame query."""
    return spark.sql(sql, **dict(views or {}))


def read_sql_jdbc(
    spark: SparkSession, url: str, sql: str, properties: Mapping[str, str] | None = None,
    **options,
) -> DataFrame:
    """S10 against a SQL database: one query text run by the database over
    JDBC, returned as a DataFrame (``partitionColumn`` / ``lowerBound`` /
    ``upperBound`` / ``numPartitions`` in ``options`` split large reads)."""
    r = spark.read.format("jdbc").option("url", url).option("query", sql)
    for k, v in {**dict(properties or {}), **options}.items():
        r = r.option(k, str(v))
    return r.load()


def _text(v: str) -> str:  # a SQL string literal
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(v: str) -> str:  # a quoted identifier
    return "`" + v.replace("`", "``") + "`"


def register_layer(
    spark: SparkSession, layer: str, database: str, *, move: bool = False, location: str | None = None
) -> list[str]:
    """Make every table folder of a layer queryable as ``<database>.<table>``
    in Spark's catalog (external Parquet tables: the catalog holds only
    their location, dropping one never touches its files).

    An external table of the same name at the same place is registered anew,
    and with ``move`` so is one at another place (a layer that was moved or
    written again elsewhere). Any other table of that name is left alone and
    raises ``ValueError`` before anything is registered. A new database is
    made in the catalog's own folder, or at ``location``; never in the layer,
    since some catalogs delete a database's folder when it is dropped.

    The Spark-side counterpart of loading a layer into a SQL database: the
    same ``SELECT ... FROM gold.<table>`` text then runs through Catalyst.
    """
    from strata.sources.files import lake_tables, qualified

    root = layer.rstrip("/")
    db = _ident(database)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}" + (f" LOCATION {_text(location)}" if location else ""))
    tables = lake_tables(spark, root)
    known = [n for n in tables if spark.catalog.tableExists(f"{db}.{_ident(n)}")]
    for name in known:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.{_ident(name)}").collect()
        told = {r["col_name"]: r["data_type"] for r in rows}
        here = qualified(spark, told.get("Location", "/")) == qualified(spark, f"{root}/{name}")
        if told.get("Type") != "EXTERNAL" or not (here or move):
            raise ValueError(f"{database}.{name} is another table: {told.get('Type')} at {told.get('Location')}")
    for name in known:
        spark.sql(f"DROP TABLE {db}.{_ident(name)}")
    for name in tables:
        spark.sql(f"CREATE TABLE {db}.{_ident(name)} USING parquet LOCATION {_text(root + '/' + name)}")
    return tables


@contextmanager
def registered_layer(spark: SparkSession, layer: str) -> Iterator[str]:
    """A database of its own with the layer's tables, for as long as the block
    runs; yields its (quoted) name. Runs side by side on one catalog never
    meet. Frames made in the block are resolved to the table's files then and
    stay usable after it; the files are never touched."""
    from strata.session import scratch_path

    name = f"layer_{uuid.uuid4().hex}"
    register_layer(spark, layer, name, location=scratch_path(spark, "database"))
    try:
        yield _ident(name)
    finally:
        spark.sql(f"DROP DATABASE {_ident(name)} CASCADE")
