"""Labels from a table (F4): the literal map's results, any size, any skew."""

import pytest
from pyspark.sql import functions as F

from strata.functions.channels import SOURCE_LABELS, label_of
from strata.operators.lookup import with_labels


def _facts(spark):
    codes = ["gsearch"] * 60 + ["bsearch"] * 3 + ["other", "", None, None] + [f"code{i}" for i in range(33)]
    return spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "id int, code string").repartition(5)


@pytest.fixture(params=["planner's choice", "shuffled join"])
def joins(request, spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffled join":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_table_gives_what_the_literal_map_gives(spark, joins):
    mapping = spark.createDataFrame([*SOURCE_LABELS.items(), ("code3", "three"), ("unused", "x"), (None, "y"), ("other", None)], "code string, label string")
    literal = {**SOURCE_LABELS, "code3": "three"}
    want = sorted(map(tuple, _facts(spark).select("id", "code", label_of("code", literal).alias("shown")).collect()))
    for split in (True, False):
        got = with_labels(_facts(spark), "code", mapping, out="shown", split_hot=split)
        assert got.columns == ["id", "code", "shown"] and sorted(map(tuple, got.collect())) == want
    in_place = with_labels(_facts(spark), "code", mapping)
    assert sorted(map(tuple, in_place.collect())) == sorted((i, s) for i, _, s in want)


def test_codes_of_another_type_and_empty_tables(spark, joins):
    mapping = spark.createDataFrame([(1, "one"), (2, "two")], "k int, v string")
    facts = spark.createDataFrame([("1",), ("2",), ("3",), (None,)], "code string")
    got = with_labels(facts, "code", mapping, code="k", label="v").collect()
    assert sorted(r[0] or "" for r in got) == ["", "3", "one", "two"]
    assert with_labels(facts.where("false"), "code", mapping, code="k", label="v").collect() == []
    same = with_labels(facts, "code", mapping.where("false"), code="k", label="v").collect()
    assert sorted(r[0] or "" for r in same) == ["", "1", "2", "3"]


def test_repeated_codes_are_refused(spark):
    mapping = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "code string, label string")
    with pytest.raises(ValueError, match="repeats a"):
        with_labels(spark.createDataFrame([("a",)], "code string"), "code", mapping)


def test_a_frequent_code_is_not_one_join_task(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(100_000, numPartitions=32).select(
            F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("code"))
        mapping = spark.createDataFrame([("hot", "H"), ("1", "one")], "code string, label string")
        joined = with_labels(facts, "code", mapping)
        rows = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(rows) == 100_000 and max(rows) < 20_000
        assert joined.where("code = 'H'").count() == 33_334
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
