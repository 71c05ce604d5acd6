"""Invariants on seeded random visits and conversions."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.channels import channel_performance, label_visits
from strata.operators.trend import period_trend, visits_per_period

SOURCES = ["gsearch", "bsearch", "x", None]
CAMPAIGNS = ["nonbrand", "brand", None, "y"]
REFS = ["https://www.gsearch.com", "http://a.b/", "junk", "", None]


def make(spark, seed):
    rnd = random.Random(seed)
    visits = [
        (i, f"2020-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d} 10:00:00",
         rnd.choice(SOURCES), rnd.choice(CAMPAIGNS), rnd.choice(REFS))
        for i in range(300)
    ]
    conv = [
        (rnd.randint(0, 330), f"2020-{rnd.randint(1, 12):02d}-01 00:00:00",
         round(rnd.uniform(0, 100), 2))
        for _ in range(500)
    ]
    v = spark.createDataFrame(
        visits, "website_session_id long, created_at string, utm_source string, "
        "utm_campaign string, http_referer string"
    ).withColumn("created_at", F.to_timestamp("created_at"))
    c = spark.createDataFrame(conv, "website_session_id long, created_at string, price_usd double") \
        .withColumn("created_at", F.to_timestamp("created_at"))
    return v, c


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_totals_add_up(spark, seed):
    v, c = make(spark, seed)
    perf = channel_performance(v, c)
    agg = perf.agg(F.sum("sessions"), F.sum("orders")).first()
    assert agg[0] == v.count()
    labeled = label_visits(v)
    # conversions with no visit, or with a NULL-channel visit, are not attributed
    attributed = c.join(labeled.where(F.col("channel").isNotNull()), "website_session_id").count()
    assert agg[1] == attributed
    monthly = period_trend(v, c)
    assert monthly.agg(F.sum("sessions")).first()[0] == v.count()
    assert visits_per_period(v).count() == monthly.count()


def test_duplicate_visit_ids_fan_out(spark):
    v = spark.createDataFrame(
        [(1, "gsearch", "brand"), (1, "bsearch", "brand")],
        "website_session_id long, utm_source string, utm_campaign string",
    ).withColumn("http_referer", F.lit(None).cast("string"))
    c = spark.createDataFrame([(1, 5.0), (1, 7.0)], "website_session_id long, price_usd double")
    got = {r.channel: (r.orders, r.revenue) for r in channel_performance(v, c).collect()}
    assert got == {"Google Ads · marque": (2, 12.0), "Bing Ads · marque": (2, 12.0)}


def test_hot_visit_key_collapses_before_shuffle(spark):
    """A visit id holding most conversions: the per-visit aggregate's
    partial half runs before the exchange (map-side combine)."""
    v = spark.createDataFrame([(0, "gsearch", "brand", None)],
                              "website_session_id long, utm_source string, "
                              "utm_campaign string, http_referer string")
    c = spark.range(20000).select(F.lit(0).cast("long").alias("website_session_id"),
                                  F.lit(1.0).alias("price_usd"))
    perf = channel_performance(v, c)
    assert perf.first().orders == 20000
    plan = perf._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan or "HashAggregate" in plan


def test_hot_visit_id_is_salted_with_the_same_result(spark):
    from strata.operators.channels import channel_orders, hot_keys

    rows = [(0, "gsearch", "brand", None)] * 40 + [
        (0, None, None, "https://www.bsearch.com")] * 20 + [
        (i, None, None, None) for i in range(1, 41)]
    v = spark.createDataFrame(
        rows, "website_session_id long, utm_source string, utm_campaign string, http_referer string")
    c = spark.createDataFrame([(0, 1.5), (0, 2.25), (3, 4.0), (77, 9.0)],
                              "website_session_id long, price_usd double")
    hot = hot_keys(v, "website_session_id", partitions=4)
    assert set(hot) == {0} and hot[0] >= 2
    salted = sorted(map(tuple, channel_performance(v, c, salt_hot_visits=True).collect()), key=str)
    plain = sorted(map(tuple, channel_performance(v, c, salt_hot_visits=False).collect()), key=str)
    assert salted == plain
    by = {r[0]: r for r in salted}
    assert by["Google Ads · marque"][2:4] == (40, 80)   # 40 visits x 2 conversions
    labeled = label_visits(v)
    assert sorted(map(tuple, channel_orders(labeled, c, salt_hot_visits=True).collect()),
                  key=str) == sorted(
        map(tuple, channel_orders(labeled, c, salt_hot_visits=False).collect()), key=str)
    assert hot_keys(spark.range(100).withColumnRenamed("id", "k"), "k", partitions=4) == {}


def _spread(spark, visits, conversions, visit_id="website_session_id"):
    """Rows of each join task's visit side, with sort-merge joins only."""
    from strata.operators.channels import _attach_conversions

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = _attach_conversions(visits, conversions, visit_id=visit_id, amount="price_usd",
                                     how="left", salt_hot_visits=True)
        return [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_one_hot_id_in_a_tiny_file_is_split(spark, tmp_path):
    path = f"{tmp_path}/v"
    spark.range(400_000, numPartitions=32).select(
        F.lit(7).cast("long").alias("website_session_id"), F.lit("c").alias("channel")
    ).write.parquet(path)
    v = spark.read.option("x", "y").parquet(path)
    conf = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        c = spark.createDataFrame([(7, 1.0)], "website_session_id long, price_usd double")
        rows = _spread(spark, v, c)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", conf)
    assert sum(rows) == 400_000 and max(rows) < 200_000


def test_visits_without_an_id_are_spread(spark):
    v = spark.range(100_000, numPartitions=32).select(
        F.when(F.col("id") % 50 == 0, F.col("id")).alias("website_session_id"), F.lit("c").alias("channel"))
    c = spark.createDataFrame([(0, 1.0), (None, 5.0)], "website_session_id long, price_usd double")
    rows = _spread(spark, v, c)
    assert sum(rows) == 100_000 and max(rows) < 25_000


def test_every_hot_id_is_found(spark):
    from strata.operators.channels import hot_keys

    v = spark.range(200_000).select((F.col("id") % 100).alias("k"))
    assert len(hot_keys(v, "k", partitions=400)) == 100
    assert set(hot_keys(v, "k", partitions=400).values()) == {4}
    assert hot_keys(v, "k", partitions=100) == {}


def test_hot_totals_are_summed_before_they_are_handed_out(spark):
    """No conversion is copied: the plan has no generator, one exchange of the
    conversions, and only the hot ids' list and their totals are broadcast."""
    from strata.operators.channels import _attach_conversions

    v = spark.range(9000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, 11).otherwise(F.col("id")).cast("long").alias("website_session_id"),
        F.lit("c").alias("channel"))
    c = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("long").alias("website_session_id"),
        F.col("id").cast("double").alias("price_usd"))
    sums = {}
    for r in c.collect():
        n, total = sums.get(r[0], (0, 0.0))
        sums[r[0]] = (n + 1, total + r[1])
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, x in conf.items():
        spark.conf.set(k, x)
    try:
        for how in ("left", "inner"):
            out = _attach_conversions(v, c, visit_id="website_session_id", amount="price_usd", how=how, salt_hot_visits=True)
            assert out.columns == ["website_session_id", "channel", "orders", "_exact", "_double"]
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "Generate" not in plan and "ReusedExchange" in plan
            got = sorted((r[0], r[2] or 0, float(r[3] or 0) + (r[4] or 0)) for r in out.collect())
            ids = [r[0] for r in v.collect()]
            want = sorted((i, *sums.get(i, (0, 0.0))) for i in ids if how == "left" or i in sums)
            assert got == want  # id 11 is hot and has a few conversions, others have none
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)
