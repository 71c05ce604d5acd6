"""Bindings: the driver's test tables seen as visits and conversions.

The operators take visit / conversion frames with the column names used
throughout the library (``website_session_id``, ``created_at``,
``utm_source``, ``utm_campaign``, ``http_referer``, ``device_type``,
``price_usd``). These functions project whole test tables onto those names
(a pure projection: Catalyst prunes the unused columns at the scan).

B1  visits = ``orders``; conversions = every ``lineitem`` row, linked to
    its order by ``l_orderkey`` and timed by ``l_shipdate``. Acquisition
    fields are derived from the order key and status, so that all three
    channel types and both mapped and unmapped codes occur.
B2  visits = every ``events`` row; conversions = purchase events.
B3  referrer URLs = ``pages.url``.
B4  visits = every ``events`` row under its ``user_id`` (ids repeat), some paid
    ones without a campaign; conversions = every ``orders`` row under its
    customer, most of which match no visit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the B1 binding (the oracle SQL spells the same values).
# ---------------------------------------------------------------------------
B1_SOURCES = ("gsearch", "bsearch", "socialbook", "newsource")
B1_CAMPAIGNS = ("nonbrand", "brand", "desktop_targeted", "pilot", "other")
B1_OPEN_REFERER = "https://www.gsearch.com"
B1_DONE_REFERERS = ("https://www.gsearch.com/q", "http://bsearch.com", "https://m.other.org/")
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(key: Column, values) -> Column:
    """``values[key mod len(values)]``: an array lookup."""
    return F.get(F.array(*map(F.lit, values)), F.pmod(key, F.lit(len(values))).cast("int"))


def b1_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 visits: every ``orders`` row with derived acquisition fields."""
    o = table(spark, sf_dir, "orders")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    is_open, is_done = status == "O", status == "F"
    referer = F.when(is_open & (F.pmod(key, F.lit(2)) == 0), F.lit(B1_OPEN_REFERER)).when(
        is_done, _pick(key, B1_DONE_REFERERS)
    )
    return o.select(
        key.alias("website_session_id"),
        F.col("o_orderdate").alias("created_at"),
        F.when(is_open, _pick(key, B1_SOURCES)).alias("utm_source"),
        F.when(is_open, _pick(key, B1_CAMPAIGNS)).alias("utm_campaign"),
        referer.alias("http_referer"),
        F.when(F.pmod(key, F.lit(3)) == 0, F.lit("mobile")).otherwise(F.lit("desktop")).alias(
            "device_type"
        ),
    )


def b1_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 conversions: every ``lineitem`` row, linked by order key."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("website_session_id"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_extendedprice").alias("price_usd"),
    )


def b2_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 visits: every ``events`` row."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("website_session_id"), F.col("ts").alias("created_at")
    )


def b2_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 conversions: purchase events."""
    ev = table(spark, sf_dir, "events")
    return ev.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("website_session_id"),
        F.col("ts").alias("created_at"),
        F.col("value").alias("price_usd"),
    )


def b3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page ids and URLs."""
    return table(spark, sf_dir, "pages").select("page_id", "url")


def b4_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4 visits: every ``events`` row, ids repeated; every fifth has no campaign."""
    ev = table(spark, sf_dir, "events")
    n = F.col("event_id")
    kind = F.pmod(n, F.lit(3))
    return ev.select(
        F.col("user_id").alias("website_session_id"),
        F.col("ts").alias("created_at"),
        F.when(kind == 0, _pick(n, B1_SOURCES)).alias("utm_source"),
        F.when((kind == 0) & (F.pmod(n, F.lit(5)) != 0), _pick(n, B1_CAMPAIGNS)).alias("utm_campaign"),
        F.when(kind == 1, _pick(n, B1_DONE_REFERERS)).alias("http_referer"),
    )


def b4_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4 conversions: every ``orders`` row under its customer."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("website_session_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_totalprice").alias("price_usd"),
    )
