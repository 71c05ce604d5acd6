"""The hand-made golden example: silver, monthly trend, channel table."""

from pyspark.sql import functions as F

from conftest import rows
from strata.operators.channels import (
    channel_orders,
    channel_performance,
    channel_sessions,
    join_channel_totals,
    label_visits,
)
from strata.operators.trend import period_trend

MONTHLY = [
    ("2012-03", 3, 2, 70.0, 66.67, 35.0),
    ("2012-04", 3, 2, 35.0, 66.67, 17.5),
    ("2012-05", 1, 0, 0.0, 0.0, None),
]

CHANNELS = [
    ("Google Ads · acquisition", "Payant", 1, 1, 100.0, 49.99, 49.99),
    ("Bing · naturel", "Naturel", 1, 1, 100.0, 20.01, 20.01),
    ("Accès direct", "Direct", 2, 1, 50.0, 10.0, 5.0),
    (None, "Payant", 1, 0, 0.0, 0.0, 0.0),
    ("newsrc Ads · xx", "Payant", 1, 0, 0.0, 0.0, 0.0),
    (" · naturel", "Naturel", 1, 0, 0.0, 0.0, 0.0),
]


def test_silver_sessions(golden):
    sessions, orders = golden
    assert sessions.count() == 7  # one exact duplicate and one NULL key gone
    assert dict(sessions.dtypes)["created_at"] == "timestamp"
    assert orders.count() == 5


def test_monthly_trend(golden):
    sessions, orders = golden
    got = period_trend(sessions, orders)
    assert got.columns == [
        "year_month", "sessions", "orders", "revenue", "conversion_rate_pct", "aov_usd"
    ]
    assert rows(got) == MONTHLY
    assert dict(got.dtypes) == {
        "year_month": "string", "sessions": "bigint", "orders": "bigint",
        "revenue": "double", "conversion_rate_pct": "double", "aov_usd": "double",
    }


def test_channel_performance(golden):
    sessions, orders = golden
    got = channel_performance(sessions, orders)
    assert sorted(rows(got), key=str) == sorted(CHANNELS, key=str)
    # sorted by revenue, largest first
    revenue = [r["revenue"] for r in got.collect()]
    assert revenue == sorted(revenue, reverse=True)


def test_channel_performance_parts_agree(golden):
    sessions, orders = golden
    labeled = label_visits(sessions)
    parts = join_channel_totals(channel_sessions(labeled), channel_orders(labeled, orders))
    assert sorted(rows(parts), key=str) == sorted(CHANNELS, key=str)


def test_unknown_label_keeps_conversions(golden):
    sessions, orders = golden
    got = channel_performance(sessions, orders, unknown_label="?")
    by_channel = {r["channel"]: r for r in got.collect()}
    assert by_channel["Google Ads · ?"]["orders"] == 1
    assert None not in by_channel


def test_channel_label_collision_joins_on_channel_only(spark):
    """Two types with one label share the label's conversions."""
    visits = spark.createDataFrame(
        [(1, "a", "naturel", None), (2, None, None, "https://a Ads/x")],
        "website_session_id int, utm_source string, utm_campaign string, http_referer string",
    ).withColumn("created_at", F.lit(None).cast("timestamp"))
    conv = spark.createDataFrame([(1, 10.0)], "website_session_id int, price_usd double")
    got = {(r["channel"], r["channel_type"]): r["orders"] for r in
           channel_performance(visits, conv).collect()}
    assert got == {("a Ads · naturel", "Payant"): 1, ("a Ads · naturel", "Naturel"): 1}
