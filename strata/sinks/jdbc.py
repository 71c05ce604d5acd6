"""SQL database sink over JDBC (K5, K6).

Overwrite drops and re-creates the target table (``truncate=false``).
``batchsize`` is the number of rows per INSERT round trip; each write task
opens its own connection, so ``num_partitions`` bounds the number of
connections the database sees (Spark coalesces to it before writing).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from strata.sources.files import lake_tables
from strata.sources.lake import read_table

BATCH_SIZE = 10_000


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    *,
    batch_size: int = BATCH_SIZE,
    num_partitions: int | None = None,
) -> None:
    """K5: overwrite ``table`` (``schema.name``) with ``df``."""
    w = (
        df.write.mode("overwrite")
        .option("truncate", "false")
        .option("batchsize", str(batch_size))
    )
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    w.jdbc(url=url, table=table, properties=dict(properties or {}))


def load_layer(
    spark: SparkSession,
    layer: str,
    schema: str,
    url: str,
    properties: Mapping[str, str] | None = None,
    **kw,
) -> list[tuple[str, int]]:
    """K6: every table folder of a layer into ``<schema>.<table>``.

    Returns ``(table, rows)`` per table, rows counted by the write itself;
    an empty layer returns ``[]``.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    loaded = []
    for name in lake_tables(spark, layer):
        obs = Observation(f"jdbc_{schema}_{name}")
        df = read_table(spark, layer, name).observe(obs, F.count(F.lit(1)).alias("rows"))
        write_jdbc(df, url, f"{schema}.{name}", properties, **kw)
        loaded.append((name, int(obs.get["rows"])))
    return loaded
