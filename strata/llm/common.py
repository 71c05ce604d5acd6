"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import written_once

# ASCII white space, the separator of words in every operator here.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str):
    """A top-level column whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


#: Written once under the shared checkpoint folder and read back: cuts the lineage
#: (a lost executor cannot take the rows with it) and gives Spark the real size of
#: the table for its join planning.
materialized = written_once


def running_totals(df: DataFrame, group: list[str], order: list[Column], **values: Column) -> DataFrame:
    """``df`` with running sums of ``values``, each row's own included, over the
    rows of its group (columns without nulls; none: all rows) in the order of
    ``order``, which tells the rows of a group apart.

    The rows are sorted over many tasks and written with the number of their
    partition. A partition's rows are summed up by themselves; what lies before
    them in their group are sums per partition, at most as many rows a group as
    there are partitions. So a group of any size is spread over many tasks.
    """
    sums = {f"_{k}": F.sum(f"_{k}") for k in values}
    placed = materialized(
        df.withColumns({f"_{k}": v for k, v in values.items()})
        .repartitionByRange(*[F.col(g) for g in group], *order)
        .withColumn("_part", F.spark_partition_id()),
        "running",
    )
    parts = placed.groupBy("_part", *group).agg(*[v.alias(f"_of{k}") for k, v in sums.items()])
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("_part", *group, *[F.sum(f"_of{k}").over(earlier).alias(f"_before{k}") for k in sums])
    here = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = {k: F.coalesce(f"_before_{k}", F.lit(0)) + F.sum(f"_{k}").over(here) for k in values}
    return placed.join(before, ["_part", *group]).select(*df.columns, *[v.alias(k) for k, v in totals.items()])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph of ``bigint`` nodes.

    Returns ``node, component`` (the smallest node of the component) for every
    node that has an edge to another node. Alternates large-star and small-star
    steps: each is a minimum per node (combined before its shuffle) and a join
    with that minimum, so a node with many neighbours never gathers them in one
    place, and the edge list does not grow. Every round is written to the
    shared folder; the loop ends when a round leaves the edges as they were.
    """
    e = materialized(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(nearest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lowest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        e = materialized(small, "edges")
        now = e.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    # every remaining edge joins a node to the smallest node of its component
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
