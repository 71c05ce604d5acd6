"""Parquet sinks with a row-count audit (K2, K3, K4).

The count comes from an ``Observation`` filled in by the write job itself,
so auditing costs no second execution of the plan. The observation sits
directly under the writer, in the job's final stage, where Spark applies
each task's metrics once even when tasks are retried.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def write_observed(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by=None,
    drop=(),
    **metrics: Column,
) -> dict:
    """Write ``df`` (without the ``drop`` columns) as Parquet at ``path``;
    return ``rows`` and the named aggregate ``metrics``, all computed over
    the rows written by the same job."""
    obs = Observation(f"write_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                          *[m.alias(k) for k, m in metrics.items()])
    writer = observed.drop(*drop).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.parquet(path)
    return dict(obs.get)


def write_table(
    df: DataFrame, path: str, *, mode: str = "overwrite", partition_by=None
) -> int:
    """Write ``df`` as Parquet at ``path``; return the number of rows written."""
    return int(write_observed(df, path, mode=mode, partition_by=partition_by)["rows"])


class ContentMismatch(RuntimeError):
    """What a table holds is not what was written to it."""


def _hashable(c: Column, kind: DataType) -> Column:
    """A value as Spark can hash it: maps as their sorted entries, at any depth."""
    if isinstance(kind, MapType):
        entries = ArrayType(StructType().add("key", kind.keyType).add("value", kind.valueType))
        return F.array_sort(_hashable(F.map_entries(c), entries))
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: F.struct(x.isNull(), _hashable(x, kind.elementType)))
    if isinstance(kind, StructType):
        fields = [_hashable(c.getField(f.name), f.dataType) for f in kind.fields]
        return F.struct(c.isNull(), *[x for f in fields for x in (f.isNull(), f)])
    if isinstance(kind, VariantType):
        return F.to_json(c)
    return c


def content_digest(schema: StructType) -> dict[str, Column]:
    """Aggregates that tell tables with other rows apart, whatever their order:
    rows, and the sum and the exclusive or of a 64-bit hash of each row (with
    which cells are null, as the hash skips nulls)."""
    cells = [F.col("`" + f.name.replace("`", "``") + "`") for f in schema.fields]
    nulls = F.concat(F.lit(""), *[c.isNull().cast("int").cast("string") for c in cells])
    row = F.xxhash64(nulls, *[_hashable(c, f.dataType) for c, f in zip(cells, schema.fields)])
    return {
        "content_rows": F.count(F.lit(1)),
        "content_sum": F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)),
        "content_xor": F.coalesce(F.bit_xor(row), F.lit(0)),
    }


def verify_content(spark: SparkSession, path: str, written: dict, schema: StructType) -> None:
    """Compare the table at ``path`` with the digest taken when it was written;
    raises ``ContentMismatch`` on any lost, repeated or changed row."""
    digest = content_digest(schema)
    found = spark.read.schema(schema).parquet(path).agg(*[c.alias(k) for k, c in digest.items()]).first()
    wrong = [f"{k}: wrote {written[k]}, found {found[k]}" for k in digest if written[k] != found[k]]
    if wrong:
        raise ContentMismatch(f"{path}: {'; '.join(wrong)}")


def write_verified(df: DataFrame, path: str, *, mode: str = "overwrite", drop=(), **metrics: Column) -> dict:
    """K4 by content: ``write_observed``, with a digest of all rows observed by
    the write itself; the table is then read back and compared with it."""
    schema = df.drop(*drop).schema
    written = write_observed(df, path, mode=mode, drop=drop, **metrics, **content_digest(schema))
    verify_content(df.sparkSession, path, written, schema)
    return written
