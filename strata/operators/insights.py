"""Report figures over the gold tables.

Inputs are the two gold frames: ``monthly`` (period trend) and
``channels`` (channel performance). Every figure is either a global
aggregate (constant-size buffers, one row out) or an ordered ``limit``
(Spark's TakeOrderedAndProject keeps k rows per partition and merges them),
so nothing is collected, no window runs over an unpartitioned frame and no
cross join is used. One-row results are put side by side with
:func:`side_by_side` (a union of the rows, then one aggregate that keeps the
single non-NULL value of every column).

Months are read in calendar order with the NULL month last, and channels
by revenue, as the report's SQL reads them; ties, which the reference
leaves to chance, are broken by name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.channels import CHANNEL_TYPES, PAID
from strata.session import written_once
from strata.functions.ratios import abs_change, growth_pct, money_sum, pct, ratio
from strata.functions.text import (
    IMPROVING,
    WORSENING,
    direction,
    grouped,
    percent_text,
    thousands_usd,
)

MIN_SESSIONS = 100
WINDOW_MONTHS = 3

# ---------------------------------------------------------------------------
# Report column headers of the reference's two tables.
# ---------------------------------------------------------------------------
CHANNEL_TABLE_HEADERS = {
    "channel": "Canal",
    "channel_type": "Type",
    "sessions": "Sessions",
    "orders": "Commandes",
    "conversion_rate_pct": "Conv. %",
    "revenue": "CA ($)",
    "revenue_per_session_usd": "CA / session ($)",
}
TYPE_TABLE_HEADERS = {
    "channel_type": "Type",
    "sessions": "Sessions",
    "orders": "Commandes",
    "conversion_rate_pct": "Conv. %",
    "revenue": "CA ($)",
    "share_revenue_pct": "Part du CA (%)",
}
TYPE_TABLE_ORDER = ("channel_type", "sessions", "orders", "conversion_rate_pct", "revenue",
                    "share_revenue_pct")
CHANNEL_TABLE_ROWS = 20
TYPE_TABLE_ROWS = 5
# ---------------------------------------------------------------------------


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Put one-row frames with distinct columns next to each other.

    Equivalent to joining single rows, without a join: the rows are
    unioned and each column keeps its one non-NULL value. A frame with no
    row leaves its columns NULL.
    """
    cols = [c for f in frames for c in f.columns]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.agg(*[F.max(c).alias(c) for c in cols])


def count_by(df: DataFrame, dim: str, *, out: str = "n") -> DataFrame:
    """Rows per value of ``dim``, most frequent first."""
    return (
        df.groupBy(dim)
        .agg(F.count(F.lit(1)).alias(out))
        .orderBy(F.desc(out), F.asc_nulls_last(dim))
    )


# -- period figures ---------------------------------------------------------


def trend_series(monthly: DataFrame, period: str = "year_month") -> DataFrame:
    """The trend in calendar order, NULL period last."""
    return monthly.orderBy(F.asc_nulls_last(period))


def kpi_totals(monthly: DataFrame) -> DataFrame:
    """A6 + F13: totals and the overall conversion (a ratio of sums)."""
    sums = monthly.agg(
        F.sum("sessions").alias("total_sessions"),
        F.sum("orders").alias("total_orders"),
        money_sum("revenue").alias("total_revenue"),
    )
    return sums.withColumn("overall_conversion_pct", pct("total_orders", "total_sessions"))


def _window_means(rows: DataFrame, suffix: str) -> DataFrame:
    return rows.agg(
        F.avg("sessions").alias(f"sessions_{suffix}"),
        F.avg("orders").alias(f"orders_{suffix}"),
        F.avg("conversion_rate_pct").alias(f"conversion_{suffix}"),
        F.avg("aov_usd").alias(f"aov_{suffix}"),
    )


def trend_windows(
    monthly: DataFrame, k: int = WINDOW_MONTHS, period: str = "year_month"
) -> DataFrame:
    """Means over the first k and the last k periods (NULLs skipped).

    With fewer than 2k periods the windows overlap; with fewer than k both
    use every period.
    """
    first = monthly.orderBy(F.asc_nulls_last(period)).limit(k)
    last = monthly.orderBy(F.desc_nulls_first(period)).limit(k)
    return side_by_side(_window_means(first, "first"), _window_means(last, "last"))


def _growth_columns() -> list:
    return [
        growth_pct("sessions_last", "sessions_first").alias("sessions_growth_pct"),
        growth_pct("orders_last", "orders_first").alias("orders_growth_pct"),
        abs_change("conversion_last", "conversion_first").alias("conversion_change"),
        abs_change("aov_last", "aov_first").alias("aov_change"),
    ]


def _direction_columns() -> list:
    return [
        direction(growth_pct("sessions_last", "sessions_first")).alias("sessions_direction"),
        direction(growth_pct("orders_last", "orders_first")).alias("orders_direction"),
        direction(F.col("conversion_last") - F.col("conversion_first"), IMPROVING, WORSENING)
        .alias("conversion_direction"),
        direction(F.col("aov_last") - F.col("aov_first")).alias("aov_direction"),
    ]


def trend_growth(monthly: DataFrame, k: int = WINDOW_MONTHS) -> DataFrame:
    """A8 + F10: growth of the window means, first to last."""
    return trend_windows(monthly, k).select("*", *_growth_columns())


def trend_direction(monthly: DataFrame, k: int = WINDOW_MONTHS) -> DataFrame:
    """the words for each trend (NULL takes the second word)."""
    return trend_windows(monthly, k).select(*_direction_columns())


def best_period(monthly: DataFrame, period: str = "year_month") -> DataFrame:
    """T4: the period with the most conversions; ties go to the earliest."""
    return monthly.orderBy(F.desc("orders"), F.asc_nulls_last(period)).limit(1)


# -- channel figures --------------------------------------------------------


def _by_revenue(channels: DataFrame) -> DataFrame:
    return channels.orderBy(F.desc("revenue"), F.asc_nulls_last("channel"), F.asc("channel_type"))


def top_channel(channels: DataFrame) -> DataFrame:
    """T5: the channel with the most revenue."""
    return _by_revenue(channels).limit(1)


def significant_channels(channels: DataFrame, min_sessions: int = MIN_SESSIONS) -> DataFrame:
    """Channels with at least ``min_sessions`` visits."""
    return channels.where(F.col("sessions") >= min_sessions)


def _best_first(df: DataFrame) -> DataFrame:
    return df.orderBy(
        F.desc("conversion_rate_pct"), F.asc_nulls_last("channel"), F.asc("channel_type")
    )


def _best_last(df: DataFrame) -> DataFrame:
    return df.orderBy(
        F.asc("conversion_rate_pct"), F.desc_nulls_first("channel"), F.desc("channel_type")
    )


def best_worst_channel(channels: DataFrame, min_sessions: int = MIN_SESSIONS) -> DataFrame:
    """T6 + F11: best and worst converting significant channels (first and
    last of one ordering), and the best one's conversion over the top
    revenue channel's, to one decimal. ``channels`` is computed once
    (written to the shared folder), then read for each figure."""
    return _best_worst(written_once(channels, "channels"), min_sessions)


def _best_worst(channels: DataFrame, min_sessions: int) -> DataFrame:
    sig = significant_channels(channels, min_sessions)
    best = _best_first(sig).limit(1).select(
        F.col("channel").alias("best_channel"),
        F.col("conversion_rate_pct").alias("best_conversion_pct"),
    )
    worst = _best_last(sig).limit(1).select(
        F.col("channel").alias("worst_channel"),
        F.col("conversion_rate_pct").alias("worst_conversion_pct"),
        F.col("revenue_per_session_usd").alias("worst_revenue_per_session_usd"),
    )
    top = top_channel(channels).select(F.col("conversion_rate_pct").alias("_top_conversion"))
    return side_by_side(best, worst, top).select(
        "best_channel",
        "best_conversion_pct",
        "worst_channel",
        "worst_conversion_pct",
        "worst_revenue_per_session_usd",
        ratio("best_conversion_pct", "_top_conversion", 1).alias("best_vs_top_ratio"),
    )


def channel_type_mix(channels: DataFrame, types=CHANNEL_TYPES) -> DataFrame:
    """Sessions, conversions and revenue per acquisition type, limited
    to ``types`` in that order (absent types dropped), with each type's share
    of the kept revenue and its conversion rate, both unrounded.

    One global aggregate with a conditional sum per type, then one row per
    type (a generator over the aggregate's single row); the share's
    denominator is in that same row, so no window or join is needed.
    """
    kept = F.col("channel_type").isin(list(types))
    aggs = [money_sum(F.when(kept, F.col("revenue"))).alias("_total")]
    for i, t in enumerate(types):
        is_t = F.col("channel_type") == t
        aggs += [
            F.count(F.when(is_t, F.lit(1))).alias(f"_n{i}"),
            F.sum(F.when(is_t, F.col("sessions"))).alias(f"_s{i}"),
            F.sum(F.when(is_t, F.col("orders"))).alias(f"_o{i}"),
            money_sum(F.when(is_t, F.col("revenue"))).alias(f"_r{i}"),
        ]
    per_type = F.array(
        *[
            F.struct(
                F.lit(i).alias("_position"),
                F.lit(t).alias("channel_type"),
                F.col(f"_n{i}").alias("_n"),
                F.col(f"_s{i}").alias("sessions"),
                F.col(f"_o{i}").alias("orders"),
                F.col(f"_r{i}").alias("revenue"),
            )
            for i, t in enumerate(types)
        ]
    )
    rows = channels.agg(*aggs).select("_total", F.inline(per_type)).where(F.col("_n") > 0)
    return (
        rows.select(
            "_position",
            "channel_type",
            "sessions",
            "orders",
            "revenue",
            pct("revenue", "_total", None).alias("share_revenue_pct"),
            pct("orders", "sessions", None).alias("conversion_rate_pct"),
        )
        .orderBy("_position")
        .drop("_position")
    )


def paid_free_share(channels: DataFrame) -> DataFrame:
    """A10: paid share of revenue (0 when there is no paid type) and the
    rest."""
    mix = channel_type_mix(channels)
    paid = mix.agg(
        F.coalesce(
            F.max(F.when(F.col("channel_type") == PAID, F.col("share_revenue_pct"))), F.lit(0.0)
        ).alias("paid_share_pct")
    )
    return paid.withColumn("free_share_pct", F.lit(100.0) - F.col("paid_share_pct"))


# -- chart series and tables (O5, O6) ----------------------------------------


def channel_revenue_series(channels: DataFrame) -> DataFrame:
    """Revenue per channel, smallest first, with a ``$123k`` label."""
    return channels.select(
        "channel", "channel_type", "revenue", thousands_usd("revenue").alias("revenue_label")
    ).orderBy(F.asc("revenue"), F.desc_nulls_first("channel"), F.desc("channel_type"))


def channel_conversion_series(channels: DataFrame, min_sessions: int = MIN_SESSIONS) -> DataFrame:
    """T8 + P6: conversion of significant channels, lowest first, with a
    ``12.30%`` label."""
    return _best_last(significant_channels(channels, min_sessions)).select(
        "channel",
        "channel_type",
        "conversion_rate_pct",
        percent_text("conversion_rate_pct").alias("conversion_label"),
    )


def _display(df: DataFrame, headers: dict, order, floats) -> DataFrame:
    cols = []
    for c in order:
        v = grouped(c) if c in floats else F.col(c)
        cols.append(v.alias(headers[c]))
    return df.select(*cols)


def channel_table(channels: DataFrame, max_rows: int = CHANNEL_TABLE_ROWS) -> DataFrame:
    """P7 + T7 + F12: the first ``max_rows`` channels by revenue, with
    report headers and ``1,234.56`` numbers."""
    top = _by_revenue(channels).limit(max_rows)
    return _display(
        top,
        CHANNEL_TABLE_HEADERS,
        list(CHANNEL_TABLE_HEADERS),
        {"conversion_rate_pct", "revenue", "revenue_per_session_usd"},
    )


def type_table(channels: DataFrame, max_rows: int = TYPE_TABLE_ROWS) -> DataFrame:
    """P7 + T7 + F12: the type mix with report headers."""
    mix = channel_type_mix(channels).limit(max_rows)
    return _display(
        mix,
        TYPE_TABLE_HEADERS,
        TYPE_TABLE_ORDER,
        {"conversion_rate_pct", "revenue", "share_revenue_pct"},
    )


# -- everything in one row (O4) ---------------------------------------------


def insight_summary(
    monthly: DataFrame,
    channels: DataFrame,
    *,
    k: int = WINDOW_MONTHS,
    min_sessions: int = MIN_SESSIONS,
) -> DataFrame:
    """Every figure the report prints, in one row. Both gold frames are
    computed once (written to the shared folder), then read for each figure."""
    monthly, channels = written_once(monthly, "monthly"), written_once(channels, "channels")
    best = best_period(monthly).select(
        F.col("year_month").alias("best_month"),
        F.col("orders").alias("best_month_orders"),
        F.col("sessions").alias("best_month_sessions"),
    )
    top = top_channel(channels).select(
        F.col("channel").alias("top_channel"),
        F.col("revenue").alias("top_channel_revenue"),
        F.col("orders").alias("top_channel_orders"),
        F.col("conversion_rate_pct").alias("top_channel_conversion_pct"),
    )
    row = side_by_side(
        kpi_totals(monthly),
        trend_windows(monthly, k),
        best,
        top,
        _best_worst(channels, min_sessions),
        paid_free_share(channels),
    )
    return row.select("*", *_growth_columns(), *_direction_columns())
