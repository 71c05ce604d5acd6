"""Plan rules for every registered query: no nested-loop or cartesian join,
no row-at-a-time Python UDF, no window without partitioning."""

import json

import pytest

import __spark_entry__ as entry
from strata.plans import catalog

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BroadcastNestedLoopJoinExec", "CartesianProductExec", "BatchEvalPythonExec")


@pytest.fixture(scope="module")
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return {
            key: json.loads(q(spark, SF)._jdf.queryExecution().executedPlan().toJSON())
            for key, q in catalog.queries().items()
        }
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _unpartitioned_windows(df):
    nodes = json.loads(df._jdf.queryExecution().executedPlan().toJSON())
    return [n for n in nodes if n["class"].endswith(".WindowExec") and not n.get("partitionSpec")]


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_plan_rules(static_plans, key):
    classes = [n["class"].rsplit(".", 1)[-1] for n in static_plans[key]]
    assert not set(FORBIDDEN) & set(classes), f"{key}: {set(FORBIDDEN) & set(classes)}"
    windows = [n for n in static_plans[key] if n["class"].endswith(".WindowExec")]
    assert all(n.get("partitionSpec") for n in windows), f"{key}: unpartitioned window"


def test_rule_check_sees_unpartitioned_windows(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(5).withColumn("r", F.row_number().over(Window.orderBy("id")))
        assert _unpartitioned_windows(df)
        part = Window.partitionBy(F.col("id") % 2).orderBy("id")
        assert not _unpartitioned_windows(spark.range(5).withColumn("r", F.row_number().over(part)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("key", ["monthly_trend", "daily_trend", "channel_performance",
                                 "channel_orders", "channel_table"])
def test_gold_and_report_scans_read_few_columns(static_plans, key):
    scans = [n for n in static_plans[key] if n["class"].endswith(".FileSourceScanExec")]
    assert scans, key
    for n in scans:
        schema = json.loads(n["requiredSchema"]) if isinstance(n.get("requiredSchema"), str) \
            else n["requiredSchema"]
        assert len(schema["fields"]) <= 3, (key, [f["name"] for f in schema["fields"]])


@pytest.mark.parametrize("key", ["insight_summary", "best_worst_channel"])
def test_gold_is_computed_once(spark, monkeypatch, key):
    """Each gold frame is written once, by a plan that scans a fact table at
    most once; the figures then read only what was written."""
    from strata.operators import insights

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plans = []
    once = insights.written_once

    def recorded(df, label):
        plans.append(json.loads(df._jdf.queryExecution().executedPlan().toJSON()))
        return once(df, label)

    monkeypatch.setattr(insights, "written_once", recorded)

    def facts(plan):
        text = [str(n.get("relation", "")) + str(n.get("tableIdentifier", "")) + json.dumps(n) for n in plan
                if n["class"].endswith(".FileSourceScanExec")]
        return [t for t in text if "l_orderkey" in t or "o_orderkey" in t or "l_shipdate" in t or "o_orderdate" in t]

    try:
        final = json.loads(entry.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toJSON())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(plans) == (2 if key == "insight_summary" else 1)
    for plan in plans:
        assert len(facts(plan)) == 2  # visits and conversions, once each
    assert facts(final) == []
