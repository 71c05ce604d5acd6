"""Looking up rows by a key of any skew.

A left table of facts gets the columns of a right table with at most one row a
key. Small right tables are broadcast by the planner; larger ones meet the facts
in a shuffled join, where a key that a large share of the facts carries would end
in one task, and so would all facts without a key.

Such keys are always looked for first, in one pass over the facts' keys with a
frequent-items sketch (``approx_top_k``): a key that holds more than
``HOT_FACTOR`` average shuffle partitions' rows. There are at most
``partitions / HOT_FACTOR`` of them, so their rows of the right table are a small
table by construction: it is broadcast, and their facts get its columns where they
are read. In the join that follows they have no key, and facts without a key match
nothing and are spread over all partitions by their input partition; its number
depends on no row order, so a retried task deals its rows alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A key is hot when it holds more rows than this many average shuffle partitions.
HOT_FACTOR = 2.0
# Items the frequent-items sketch tracks: a multiple of the partitions, so that
# every key above the threshold is among them; the function's own limits.
SKETCH_FACTOR, SKETCH_LEAST, SKETCH_MOST = 8, 10_000, 1_000_000
SALT = "_salt"


def shuffle_partitions(spark) -> int:
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str, *, partitions: int | None = None, factor: float = HOT_FACTOR) -> dict:
    """Every key of ``df`` holding more than ``factor`` average shuffle
    partitions' worth of rows, each with a number of buckets that brings it
    down to about one partition.

    One aggregate pass: a frequent-items sketch (``approx_top_k``, bounded
    memory) and the row count. At most ``partitions / factor`` keys can be
    above the threshold; that many come back to the driver.
    """
    if partitions is None:
        partitions = shuffle_partitions(df.sparkSession)
    tracked = min(SKETCH_MOST, max(SKETCH_LEAST, SKETCH_FACTOR * partitions))
    most = min(tracked, math.ceil(partitions / factor) + 1)
    top = F.call_function("approx_top_k", F.col(key), F.lit(most), F.lit(tracked))
    row = df.agg(top.alias("top"), F.count(key).alias("n")).first()
    if not row or not row["n"]:
        return {}
    per_partition = row["n"] / partitions
    return {
        t["item"]: min(partitions, math.ceil(t["count"] / per_partition))
        for t in row["top"] or []
        if t["item"] is not None and t["count"] > factor * per_partition
    }


def no_salt(key: str) -> Column:
    """0 in a form that is no constant: Spark would drop a constant join key,
    and with it the spreading of rows without a key. It is never null, so no
    filter is inferred from it that would keep equal exchanges apart."""
    return F.coalesce(F.pmod(F.hash(key), F.lit(1)), F.lit(0))


def _all(df: DataFrame) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def attach(facts: DataFrame, found: DataFrame, key: str, *, how: str = "left") -> DataFrame:
    """``facts`` with the columns of ``found``, which has at most one row a
    ``key``, none without a key, and ``SALT`` from ``no_salt``; ``how`` is ``left``
    or ``inner`` (facts of a key that ``found`` lacks go).

    ``found`` is computed once: the hot keys' rows come from the same exchange as
    the join's (no second scan where ``found`` is an aggregate)."""
    spark = facts.sparkSession
    values = [c for c in found.columns if c not in (key, SALT)]
    hot = hot_keys(facts.select(key), key)
    # No key, no match: such rows may go anywhere.
    spread = F.when(F.col(key).isNull(), F.lit(shuffle_partitions(spark))).otherwise(F.lit(1))
    if not hot:
        dealt = facts.withColumn(SALT, F.pmod(F.spark_partition_id(), spread))
        return dealt.join(found, on=[key, SALT], how=how).select(*_all(facts), *values)
    # At most partitions / factor keys, so their list and their rows are small.
    ids = spark.createDataFrame([(i,) for i in hot], StructType([facts.schema[key]]))
    theirs = found.join(F.broadcast(ids), key).select(key, *values, F.lit(True).alias("_known"))
    split = ids.join(F.broadcast(theirs), key, "left").select(
        F.col(key).alias("_hot"), F.col("_known").alias("_hot_known"), *[F.col(c).alias(f"_hot_{c}") for c in values]
    )
    dealt = (
        facts.join(F.broadcast(split), F.col(key) == F.col("_hot"), "left")
        .withColumn("_key", F.col(key))
        .withColumn(key, F.when(F.col("_hot").isNull(), F.col("_key")))
        .withColumn(SALT, F.pmod(F.spark_partition_id(), spread))
    )
    joined = dealt.join(found.withColumn("_known", F.lit(True)), on=[key, SALT], how="left")
    if how == "inner":
        joined = joined.where(F.coalesce("_hot_known", "_known"))
    of = {c: F.when(F.col("_hot").isNotNull(), F.col(f"_hot_{c}")).otherwise(F.col(c)) for c in values}
    return joined.withColumns(of).withColumn(key, F.col("_key")).select(*_all(facts), *values)


def with_labels(
    df: DataFrame, value: str, mapping: DataFrame, *, code: str = "code", label: str = "label",
    out: str | None = None, split_hot: bool = True,
) -> DataFrame:
    """F4 with a mapping of any size: ``out`` (``value`` itself by default) is the
    ``label`` of the mapping's row whose ``code`` equals ``value``; a value the
    mapping does not know, or knows without a label, is passed through, and NULL
    stays NULL.

    The result is that of ``functions.channels.label_of`` with the same pairs. The
    mapping is joined, never collected; the planner broadcasts it if it is small.
    Beyond that, ``split_hot`` keeps frequent values out of one join task. Raises
    ``ValueError`` if a code has several rows (rows would multiply)."""
    kind = df.schema[value].dataType
    labels = (
        mapping.select(F.col(code).cast(kind).alias("_code"), F.col(label).cast("string").alias("_label"))
        .where(F.col("_code").isNotNull())
    )
    repeated = labels.groupBy("_code").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(3).collect()
    if repeated:
        raise ValueError(f"mapping repeats {', '.join(str(r['_code']) for r in repeated)}")
    facts = df.withColumn("_code", F.col(value))
    if split_hot:
        joined = attach(facts, labels.withColumn(SALT, no_salt("_code")), "_code")
    else:
        joined = facts.join(labels, "_code", "left")
    shown = F.coalesce("_label", F.col(value).cast("string"))
    return joined.withColumn(out or value, shown).drop("_code", "_label")
