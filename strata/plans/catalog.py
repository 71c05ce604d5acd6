"""Query catalog: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads whole test tables through ``strata.plans.bindings`` (or
data Spark derives from them) and runs the library operator on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import channels as ch
from strata.functions.ratios import money_sum
from strata.operators import channels as chan
from strata.operators import trend
from strata.plans import bindings as b

Query = Callable[[SparkSession, str], DataFrame]


def monthly_trend(spark, sf_dir):
    return trend.period_trend(
        b.b1_visits(spark, sf_dir), b.b1_conversions(spark, sf_dir), period="month"
    )


def monthly_trend_batches(spark, sf_dir):
    """The monthly trend from stored states: visits, conversions, a late batch of
    conversions, and one batch delivered twice."""
    from strata.operators.period_state import PeriodStore
    from strata.session import scratch_path

    store = PeriodStore(spark, scratch_path(spark, "periods"))
    conversions = b.b1_conversions(spark, sf_dir)
    late = F.coalesce(F.col("price_usd") > 30_000, F.lit(False))
    store.put("visits", visits=b.b1_visits(spark, sf_dir))
    store.put("conversions", conversions=conversions.where(~late))
    store.put("late", conversions=conversions.where(late))
    store.put("late", conversions=conversions.where(late))
    return store.trend()


def monthly_sessions(spark, sf_dir):
    return trend.visits_per_period(b.b1_visits(spark, sf_dir))


def monthly_orders(spark, sf_dir):
    return trend.conversions_per_period(b.b1_conversions(spark, sf_dir))


def null_fill(spark, sf_dir):
    return trend.period_counts(b.b1_visits(spark, sf_dir), b.b1_conversions(spark, sf_dir))


def daily_trend(spark, sf_dir):
    return trend.period_trend(
        b.b2_visits(spark, sf_dir), b.b2_conversions(spark, sf_dir), period="day", out="day"
    )


def month_bucket(spark, sf_dir):
    from strata.functions.periods import period_text

    v = b.b1_visits(spark, sf_dir)
    return v.select("website_session_id", "created_at", period_text("created_at").alias("year_month"))


def channel_type(spark, sf_dir):
    v = b.b1_visits(spark, sf_dir)
    return v.select(
        "website_session_id", "utm_source", "http_referer", ch.acquisition_type().alias("channel_type")
    )


def referer_source(spark, sf_dir):
    return b.b3_urls(spark, sf_dir).select(
        "page_id", "url", ch.referer_host("url").alias("referer_source")
    )


def label_lookup(spark, sf_dir):
    v = b.b1_visits(spark, sf_dir)
    return v.select(
        "website_session_id",
        ch.label_of("utm_source", ch.SOURCE_LABELS).alias("source_label"),
        ch.label_of("utm_campaign", ch.CAMPAIGN_LABELS).alias("campaign_label"),
    )


def label_table(spark, sf_dir):
    """Labels from a table: the name of each order's customer, for customers
    that owe nothing; the code itself for all others."""
    from strata.operators.lookup import with_labels

    names = b.table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("code"))
    return with_labels(orders, "code", names, code="c_custkey", label="c_name", out="customer")


def channel_label(spark, sf_dir):
    v = chan.label_visits(b.b1_visits(spark, sf_dir))
    return v.select("website_session_id", "channel_type", "channel")


def channel_sessions(spark, sf_dir):
    return chan.channel_sessions(chan.label_visits(b.b1_visits(spark, sf_dir)))


def channel_orders(spark, sf_dir):
    return chan.channel_orders(
        chan.label_visits(b.b1_visits(spark, sf_dir)), b.b1_conversions(spark, sf_dir)
    )


def channel_performance(spark, sf_dir):
    return chan.channel_performance(b.b1_visits(spark, sf_dir), b.b1_conversions(spark, sf_dir))


def channel_performance_fanout(spark, sf_dir):
    return chan.channel_performance(b.b4_visits(spark, sf_dir), b.b4_conversions(spark, sf_dir))


def channel_orders_fanout(spark, sf_dir):
    return chan.channel_orders(
        chan.label_visits(b.b4_visits(spark, sf_dir)), b.b4_conversions(spark, sf_dir)
    )


def money_sums(spark, sf_dir):
    """Sums of sub-cent, large and partly missing amounts of every line."""
    price = F.col("l_extendedprice")
    small = F.col("l_partkey") / 1024  # up to ten decimals, each exact in a double
    missing = F.when(F.col("l_linenumber") % 2 == 0, small)
    nan = F.when(F.col("l_quantity") > 49, F.lit(float("nan"))).otherwise(price)
    return (
        b.table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", "l_linestatus", "l_linenumber")
        .agg(
            money_sum(small).alias("sub_cent"),
            money_sum(F.col("l_partkey") * 1e9).alias("large"),
            money_sum(-missing).alias("negative"),
            F.isnan(money_sum(nan)).alias("is_nan"),
        )
    )


def channel_join(spark, sf_dir):
    labeled = chan.label_visits(b.b1_visits(spark, sf_dir))
    return chan.join_channel_totals(
        chan.channel_sessions(labeled), chan.channel_orders(labeled, b.b1_conversions(spark, sf_dir))
    )


def sessions_by_device(spark, sf_dir):
    from strata.operators.insights import count_by

    return count_by(b.b1_visits(spark, sf_dir), "device_type", out="sessions")


def queries() -> dict[str, Query]:
    return _base_queries() | _insight_queries() | _file_queries()


def _base_queries() -> dict[str, Query]:
    return {
        "monthly_trend": monthly_trend,
        "monthly_trend_batches": monthly_trend_batches,
        "monthly_sessions": monthly_sessions,
        "monthly_orders": monthly_orders,
        "null_fill": null_fill,
        "daily_trend": daily_trend,
        "month_bucket": month_bucket,
        "channel_type": channel_type,
        "referer_source": referer_source,
        "label_lookup": label_lookup,
        "label_table": label_table,
        "channel_label": channel_label,
        "channel_sessions": channel_sessions,
        "channel_orders": channel_orders,
        "channel_performance": channel_performance,
        "channel_performance_fanout": channel_performance_fanout,
        "channel_orders_fanout": channel_orders_fanout,
        "money_sums": money_sums,
        "channel_join": channel_join,
        "sessions_by_device": sessions_by_device,
        "price_positions": price_positions,
    }


# -- report figures over the gold tables --------------------------------------

def _gold(spark, sf_dir):
    return monthly_trend(spark, sf_dir), channel_performance(spark, sf_dir)


def _on_monthly(fn):
    def q(spark, sf_dir):
        return fn(monthly_trend(spark, sf_dir))

    q.__name__ = fn.__name__
    return q


def _on_channels(fn):
    def q(spark, sf_dir):
        return fn(channel_performance(spark, sf_dir))

    q.__name__ = fn.__name__
    return q


def insight_summary(spark, sf_dir):
    from strata.operators.insights import insight_summary as summary

    return summary(*_gold(spark, sf_dir))


def _insight_queries() -> dict[str, Query]:
    from strata.operators import insights as ins

    return {
        "trend_series": _on_monthly(ins.trend_series),
        "kpi_totals": _on_monthly(ins.kpi_totals),
        "trend_windows": _on_monthly(ins.trend_windows),
        "trend_growth": _on_monthly(ins.trend_growth),
        "trend_direction": _on_monthly(ins.trend_direction),
        "best_month": _on_monthly(ins.best_period),
        "top_channel": _on_channels(ins.top_channel),
        "significant_channels": _on_channels(ins.significant_channels),
        "best_worst_channel": _on_channels(ins.best_worst_channel),
        "channel_type_mix": _on_channels(ins.channel_type_mix),
        "paid_free_share": _on_channels(ins.paid_free_share),
        "channel_revenue_series": _on_channels(ins.channel_revenue_series),
        "channel_conversion_series": _on_channels(ins.channel_conversion_series),
        "channel_table": _on_channels(ins.channel_table),
        "type_table": _on_channels(ins.type_table),
        "insight_summary": insight_summary,
    }


# -- silver, sources and sinks: queries over CSV / Parquet that Spark writes
# from the test tables under spark.checkpoint.dir (raw CSV once per
# application; landing, silver, gold and pipeline outputs on every call) ----

ORDERS_SPEC = {
    "primary_key": "o_orderkey",
    "columns": {
        "o_orderkey": "long",
        "o_custkey": "long",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "string",
        "o_orderpriority": "string",
    },
}
VISITS_SPEC = {
    "primary_key": "website_session_id",
    "columns": {
        "website_session_id": "long",
        "created_at": "string",
        "utm_source": "string",
        "utm_campaign": "string",
        "http_referer": "string",
        "device_type": "string",
    },
}
CONVERSIONS_SPEC = {
    "primary_key": "website_session_id",
    "columns": {
        "website_session_id": "long",
        "line_number": "int",
        "created_at": "string",
        "price_usd": "double",
    },
}


def _config(**tables):
    from strata.config import Config

    return Config.from_dict({"tables": tables})


# Raw CSV folders already written in this application, by (tables folder,
# table set): the CSV is input set-up for the file-backed keys, written once
# per application and read by every later call.
_RAW_FOLDERS: dict[tuple, str] = {}


def _raw_folder(spark, sf_dir, tables: dict) -> str:
    """A scratch folder holding test-derived frames as raw CSV tables
    ``<name>.csv`` (written on first use in this application)."""
    from strata.session import scratch_path
    from strata.sources.csv import write_csv
    from strata.sources.files import path_exists

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"),
           tuple(sorted((n, f.__name__) for n, f in tables.items())))
    raw = _RAW_FOLDERS.get(key)
    if raw and all(path_exists(spark, f"{raw}/{n}.csv/_SUCCESS") for n in tables):
        return raw
    raw = scratch_path(spark, "raw")
    for name, make in tables.items():
        write_csv(make(spark, sf_dir), f"{raw}/{name}.csv")
    _RAW_FOLDERS[key] = raw
    return raw


def _orders(spark, sf_dir):
    return b.table(spark, sf_dir, "orders")


def _pipeline_conversions(spark, sf_dir):
    li = b.table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("website_session_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_extendedprice").alias("price_usd"),
    )


def _customers(spark, sf_dir):
    return b.table(spark, sf_dir, "customer")


def csv_scan_declared(spark, sf_dir):
    from strata.config import TableSpec
    from strata.sources.csv import read_declared

    raw = _raw_folder(spark, sf_dir, {"orders": _orders})
    return read_declared(spark, f"{raw}/orders.csv", TableSpec.from_dict(ORDERS_SPEC))


def csv_scan_inferred(spark, sf_dir):
    from strata.sources.csv import read_inferred

    raw = _raw_folder(spark, sf_dir, {"orders": _orders})
    return read_inferred(spark, f"{raw}/orders.csv")


def null_sentinel(spark, sf_dir):
    from strata.config import TableSpec
    from strata.sources.csv import read_declared

    raw = _raw_folder(spark, sf_dir, {"website_sessions": b.b1_visits})
    return read_declared(
        spark, f"{raw}/website_sessions.csv", TableSpec.from_dict(VISITS_SPEC)
    )


def _spoiled_orders(spark, sf_dir):
    """Orders whose price or customer is no number in some rows."""
    key = F.col("o_orderkey")
    return _orders(spark, sf_dir).withColumns({
        "o_custkey": F.when(key % 11 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit("?"))).otherwise(F.col("o_custkey").cast("string")),
        "o_totalprice": F.when(key % 7 == 0, F.lit("unknown")).otherwise(F.col("o_totalprice").cast("string")),
    })


def csv_bad_cells(spark, sf_dir):
    """The declared scan of spoiled orders, with each row's bad cells."""
    from strata.config import TableSpec
    from strata.sources.csv import read_declared

    raw = _raw_folder(spark, sf_dir, {"orders": _spoiled_orders})
    return read_declared(spark, f"{raw}/orders.csv", TableSpec.from_dict(ORDERS_SPEC), bad="bad_cells")


def bad_cells_audit(spark, sf_dir):
    """The silver audit of spoiled orders keyed by a column with bad cells: these
    rows go, their cells are counted."""
    from strata.plans.pipeline import AUDIT_SCHEMA, Layers, bronze_step, silver_step
    from strata.session import scratch_path

    raw = _raw_folder(spark, sf_dir, {"orders": _spoiled_orders})
    layers = Layers.under(scratch_path(spark, "lake"))
    config = _config(orders={**ORDERS_SPEC, "primary_key": "o_custkey"})
    audit = silver_step(spark, bronze_step(spark, raw, layers, config), layers, config)
    return spark.createDataFrame(audit, AUDIT_SCHEMA)


def price_positions(spark, sf_dir):
    """Every order's place by price, most expensive first."""
    from strata.operators.positions import with_positions

    orders = _orders(spark, sf_dir).select("o_orderkey", "o_totalprice")
    return with_positions(orders, F.desc("o_totalprice"), F.asc("o_orderkey"))


def timestamp_cast(spark, sf_dir):
    from strata.operators.silver import cast_timestamps

    return cast_timestamps(csv_scan_declared(spark, sf_dir), ["o_orderdate"]).select(
        "o_orderkey", "o_orderdate"
    )


def dedup_rows(spark, sf_dir):
    from strata.operators.silver import drop_exact_duplicates

    profiles = b.b1_visits(spark, sf_dir).drop("website_session_id")
    return drop_exact_duplicates(profiles)


def dedup_wide_rows(spark, sf_dir):
    """Rows of lines that repeat once order keys are folded, found by digest."""
    from strata.operators.silver import drop_wide_duplicates

    lines = b.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 100).alias("l_orderkey"), "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"
    )
    return drop_wide_duplicates(lines)


def pk_not_null(spark, sf_dir):
    from strata.config import TableSpec
    from strata.operators.silver import require_key, resolve_key

    v = b.b1_visits(spark, sf_dir)
    return require_key(v, resolve_key(v, TableSpec(primary_key="utm_source")))


def silver_clean(spark, sf_dir):
    from strata.config import Defaults, TableSpec
    from strata.operators.silver import clean

    defaults = Defaults(timestamp_columns=("o_orderdate",))
    return clean(csv_scan_declared(spark, sf_dir), TableSpec.from_dict(ORDERS_SPEC), defaults)[0]


def parquet_scan(spark, sf_dir):
    from strata.sources.lake import read_table

    return read_table(spark, sf_dir, "lineitem.parquet")


def warehouse_sql(spark, sf_dir):
    from strata.sources.lake import warehouse_sql as run_sql

    monthly, channels = _gold(spark, sf_dir)
    return run_sql(
        spark,
        """SELECT channel, channel_type, sessions, orders,
                  conversion_rate_pct, revenue, revenue_per_session_usd
           FROM {gold_channel_performance} ORDER BY revenue DESC""",
        {"gold_monthly_trend": monthly, "gold_channel_performance": channels},
    )


def warehouse_catalog_sql(spark, sf_dir):
    from strata.plans.pipeline import GOLD_CHANNELS, GOLD_MONTHLY
    from strata.session import scratch_path
    from strata.sinks.parquet import write_table
    from strata.sources.lake import registered_layer

    gold = scratch_path(spark, "gold")
    monthly, channels = _gold(spark, sf_dir)
    write_table(monthly, f"{gold}/{GOLD_MONTHLY}")
    write_table(channels, f"{gold}/{GOLD_CHANNELS}")
    with registered_layer(spark, gold) as database:
        return spark.sql(
            f"""SELECT channel, channel_type, sessions, orders,
                       conversion_rate_pct, revenue, revenue_per_session_usd
                FROM {database}.gold_channel_performance ORDER BY revenue DESC"""
        )


def silver_roundtrip(spark, sf_dir):
    from strata.session import scratch_path
    from strata.sinks.parquet import write_verified

    path = scratch_path(spark, "silver")
    write_verified(b.b1_visits(spark, sf_dir), path)
    return spark.read.parquet(path)


def gold_roundtrip(spark, sf_dir):
    from strata.session import scratch_path
    from strata.sinks.parquet import write_table

    path = scratch_path(spark, "gold")
    write_table(monthly_trend(spark, sf_dir), path)
    return spark.read.parquet(path)


def raw_manifest(spark, sf_dir):
    from strata.sources.files import csv_manifest

    raw = _raw_folder(spark, sf_dir, {"orders": _orders, "customers": _customers})
    return _manifest_with_rows(spark, csv_manifest(spark, raw))


def _manifest_with_rows(spark, manifest):
    """A manifest's tables with what their files hold: rows and a check sum,
    which follow from the tables (byte sizes follow from Spark's CSV writer)."""
    from functools import reduce

    from strata.sources.csv import read_inferred

    def content(r):
        df = read_inferred(spark, r["entry"], options={"recursiveFileLookup": True})
        return df.agg(
            F.lit(r["table"]).alias("table"),
            F.lit(r["bytes"] > 0).alias("has_bytes"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(df.columns[0]).cast("long").alias("key_sum"),
            F.sum(F.length(df.columns[-1])).cast("long").alias("last_column_chars"),
        )

    return reduce(lambda x, y: x.unionByName(y), [content(r) for r in manifest.collect()])


def bronze_landing(spark, sf_dir):
    """Both raw tables landed in ranges of 64 KB: what the landed tables hold, and
    whether every landed file, read again, has its source's bytes."""
    from strata.session import scratch_path
    from strata.sinks.landing import land_files, landed_differences
    from strata.sources.files import csv_manifest

    raw = _raw_folder(spark, sf_dir, {"orders": _orders, "customers": _customers})
    bronze = scratch_path(spark, "bronze")
    landed = land_files(spark, raw, bronze, split_bytes=1 << 16)
    same = landed_differences(spark, landed).isEmpty()
    return _manifest_with_rows(spark, csv_manifest(spark, bronze)).withColumn("same_bytes", F.lit(same))


def bronze_manifest(spark, sf_dir):
    from strata.session import scratch_path
    from strata.sinks.landing import land_files
    from strata.sources.files import csv_manifest

    raw = _raw_folder(spark, sf_dir, {"orders": _orders, "customers": _customers})
    bronze = scratch_path(spark, "bronze")
    land_files(spark, raw, bronze)
    return _manifest_with_rows(spark, csv_manifest(spark, bronze))


def _silver_layer(spark, sf_dir):
    from strata.plans.pipeline import Layers, bronze_step, silver_step
    from strata.session import scratch_path

    raw = _raw_folder(
        spark, sf_dir, {"orders": _orders, "customers": _customers}
    )
    layers = Layers.under(scratch_path(spark, "lake"))
    audit = silver_step(
        spark, bronze_step(spark, raw, layers), layers, _config(orders=ORDERS_SPEC)
    )
    return layers, audit


def lake_tables(spark, sf_dir):
    from strata.sources.files import lake_tables_frame

    from functools import reduce

    from strata.sources.lake import read_table

    layers, _ = _silver_layer(spark, sf_dir)
    names = [r["table"] for r in lake_tables_frame(spark, layers.silver).collect()]
    rows = [
        read_table(spark, layers.silver, n).agg(F.lit(n).alias("table"), F.count(F.lit(1)).alias("rows"))
        for n in names
    ]
    return reduce(lambda x, y: x.unionByName(y), rows)


def load_audit(spark, sf_dir):
    from strata.plans.pipeline import AUDIT_SCHEMA

    _, audit = _silver_layer(spark, sf_dir)
    return spark.createDataFrame(audit, AUDIT_SCHEMA)


def full_run_audit(spark, sf_dir):
    from strata.plans.pipeline import Layers, run_pipeline
    from strata.session import scratch_path

    raw = _raw_folder(
        spark,
        sf_dir,
        {
            "website_sessions": b.b1_visits,
            "orders": _pipeline_conversions,
            "customers": _customers,
        },
    )
    config = _config(website_sessions=VISITS_SPEC, orders=CONVERSIONS_SPEC)
    return run_pipeline(spark, raw, Layers.under(scratch_path(spark, "lake")), config)


def resumed_run_audit(spark, sf_dir):
    """A run that stopped after silver, gone on with: its audit is a full run's."""
    from strata.plans.pipeline import Layers, run_pipeline
    from strata.session import scratch_path

    tables = {"website_sessions": b.b1_visits, "orders": _pipeline_conversions, "customers": _customers}
    raw = _raw_folder(spark, sf_dir, tables)
    config = _config(website_sessions=VISITS_SPEC, orders=CONVERSIONS_SPEC)
    layers = Layers.under(scratch_path(spark, "lake"))
    run_pipeline(spark, raw, layers, config, gold=False)
    return run_pipeline(spark, raw, layers, config, resume=True)


def _file_queries() -> dict[str, Query]:
    return {
        "csv_scan_declared": csv_scan_declared,
        "csv_scan_inferred": csv_scan_inferred,
        "csv_bad_cells": csv_bad_cells,
        "bad_cells_audit": bad_cells_audit,
        "null_sentinel": null_sentinel,
        "timestamp_cast": timestamp_cast,
        "dedup_rows": dedup_rows,
        "dedup_wide_rows": dedup_wide_rows,
        "pk_not_null": pk_not_null,
        "silver_clean": silver_clean,
        "parquet_scan": parquet_scan,
        "warehouse_sql": warehouse_sql,
        "warehouse_catalog_sql": warehouse_catalog_sql,
        "silver_roundtrip": silver_roundtrip,
        "gold_roundtrip": gold_roundtrip,
        "raw_manifest": raw_manifest,
        "bronze_landing": bronze_landing,
        "bronze_manifest": bronze_manifest,
        "lake_tables": lake_tables,
        "load_audit": load_audit,
        "full_run_audit": full_run_audit,
        "resumed_run_audit": resumed_run_audit,
    }
