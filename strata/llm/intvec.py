"""Integer vectors for the clustering operators: rows of a table of vectors on an
integer grid, their sums by group, and totals joined back to rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from strata.llm.common import col, materialized


def largest(dims: int) -> int:
    """The largest component for which squared distances of ``dims`` components
    fit in 64 bits (and a component in 32)."""
    return min(math.isqrt((2**63 - 1) // max(dims, 1)) // 2, 2**31 - 1)


def grid_vectors(df: DataFrame, *, vec_id: str, embedding: str, scale: int, limit: int, label: str | None = None) -> DataFrame:
    """``vec_id``, ``v`` (array of int, ``floor(scale * x)`` of each component x as
    double) and, if named, ``label`` of every row whose vector holds no null and
    no non-finite component; written once. Components beyond ``limit`` count as
    that."""
    chosen = [col(vec_id).alias("vec_id"), *([col(label).alias("label")] if label else []), col(embedding).alias("v")]
    source = df.select(*chosen)
    schema = StructType([*source.schema.fields[:-1], StructField("v", ArrayType(IntegerType()))])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            lists = batch.column(batch.num_columns - 1)
            valid = np.asarray(lists.is_valid().to_numpy(zero_copy_only=False), bool)
            sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
            finite = np.isfinite(values)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            wrong = np.concatenate([[0], np.cumsum(~finite)])
            ok = valid & (wrong[ends[1:]] == wrong[ends[:-1]])
            ints = np.clip(np.floor(np.where(finite, values, 0.0) * scale), -limit, limit).astype(np.int32)
            out = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ints, pa.int32()))
            arrays = [*batch.columns[:-1], out]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names).filter(pa.array(ok))

    return materialized(source.mapInArrow(batches, schema), "grid-vectors")


def first_vectors(order: DataFrame, by: list, n: int) -> np.ndarray:
    """The vectors of the first ``n`` rows in the order of ``by`` (ties by the
    vector); the only rows that reach the driver."""
    rows = order.orderBy(*by, "v").limit(n).select("v").collect()
    return np.array([r["v"] for r in rows], np.int64)


def matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """A batch's last column as rows of ``dims`` integers."""
    return batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def group_sums(
    vectors: DataFrame, dims: int, groups: int, assign: Callable[[np.ndarray], Iterable[tuple[np.ndarray, np.ndarray]]]
) -> tuple[list[list[int]], list[int]]:
    """Exact component sums and row counts of ``groups`` groups.

    ``assign`` takes a matrix of vectors and gives pairs (group of each row,
    matrix of the components that the row adds to it). A task adds up all its
    rows first, so it sends one number per group and component; the sums over
    tasks are decimals. At most ``groups`` rows reach the driver."""

    def sums(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | None = None
        count = np.zeros(groups, np.int64)
        for batch in rows:
            if not batch.num_rows:
                continue
            for group, part in assign(matrix(batch, dims)):
                if total is None:
                    total = np.zeros((groups, part.shape[1]), np.int64)
                count += np.bincount(group, minlength=groups)
                order = np.argsort(group, kind="stable")
                runs = np.flatnonzero(np.diff(group[order], prepend=-1))
                total[group[order][runs]] += np.add.reduceat(part[order], runs, axis=0)
        if total is not None:
            k, w = total.shape
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(k, dtype=np.int32), w)),
                    pa.array(np.tile(np.arange(w, dtype=np.int32), k)),
                    pa.array(total.ravel()),
                    pa.array(np.repeat(count, w)),
                ],
                names=["g", "i", "s", "n"],
            )

    parts = vectors.select("v").mapInArrow(sums, "g int, i int, s long, n long")
    found = (
        parts.groupBy("g", "i")
        .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
        .groupBy("g")
        .agg(F.array_sort(F.collect_list(F.struct("i", "s"))).alias("s"), F.max("n").alias("n"))
        .collect()
    )
    all_sums: list[list[int]] = [[] for _ in range(groups)]
    counts = [0] * groups
    for r in found:
        all_sums[r["g"]], counts[r["g"]] = [int(x["s"]) for x in r["s"]], r["n"]
    return all_sums, counts


def floor_means(sums: list[list[int]], counts: list[int], before: np.ndarray) -> np.ndarray:
    """``floor(sum / count)`` of each component; groups without rows stay."""
    out = before.copy()
    for g, n in enumerate(counts):
        if n:
            out[g] = [s // n for s in sums[g]]
    return out


def with_group_total(rows: DataFrame, key: str, value: str, out: str, partitions: int) -> DataFrame:
    """``rows`` (a written table) with the sum of ``value`` over all rows of equal
    ``key``, nulls together, as ``out``.

    The sums are one row a key, combined before their shuffle and written once.
    A key that holds more than two average partitions' rows is split: its sum is
    copied once a bucket and its rows are dealt over the buckets by their input
    partition, so no join task gets all rows of one key. At most
    ``partitions / 2`` keys are that large; only their list is broadcast.
    """
    sums = materialized(
        rows.groupBy(key).agg(F.sum(value).alias(out), F.count(F.lit(1)).alias("_n")), "group-totals"
    )
    n = sums.agg(F.sum("_n")).first()[0] or 0
    share = max(n / partitions, 1.0)
    buckets = F.when(F.col("_n") > 2 * share, F.least(F.lit(partitions), F.ceil(F.col("_n") / share)).cast("int")).otherwise(1)
    sums = sums.withColumn("_buckets", buckets)
    large = F.broadcast(sums.where("_buckets > 1").select(F.col(key).alias("_key"), "_buckets"))
    dealt = rows.join(large, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn(
        "_bucket", F.pmod(F.spark_partition_id(), F.coalesce("_buckets", F.lit(1)))
    )
    copies = sums.select(
        F.col(key).alias("_key2"), out, F.explode(F.sequence(F.lit(0), F.col("_buckets") - 1)).alias("_bucket2")
    )
    joined = dealt.join(copies, F.col(key).eqNullSafe(F.col("_key2")) & (F.col("_bucket") == F.col("_bucket2")), "left")
    return joined.drop("_key", "_buckets", "_bucket", "_key2", "_bucket2")
