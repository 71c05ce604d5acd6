"""Period trend of visits, conversions and revenue.

Plan shape: each side is one scan plus a partial (map-side) aggregate on a
truncated timestamp, so what crosses the shuffle is at most one row per
period per input partition, whatever the input size or skew (a period
holding a third of all rows collapses in the partial aggregate like any
other). The two period tables then meet in a join of two small, already
co-partitioned aggregates; AQE turns it into a broadcast join at run time
when their measured size allows. The label text is made once per period,
after the aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.periods import period_key, period_label
from strata.functions.ratios import money_sum, pct, ratio

_KEY = "_period"


def _visits_by_key(visits: DataFrame, ts, period: str) -> DataFrame:
    return visits.groupBy(period_key(ts, period).alias(_KEY)).agg(
        F.count(F.lit(1)).alias("sessions")
    )


def _conversions_by_key(conversions: DataFrame, ts, amount, period: str) -> DataFrame:
    return conversions.groupBy(period_key(ts, period).alias(_KEY)).agg(
        F.count(F.lit(1)).alias("orders"),
        money_sum(amount).alias("revenue"),
    )


def visits_per_period(
    visits: DataFrame, *, ts="created_at", period: str = "month", out: str = "year_month"
) -> DataFrame:
    """A1: ``count(*)`` of visits per period; a NULL time is its own group."""
    agg = _visits_by_key(visits, ts, period)
    return agg.select(period_label(_KEY, period).alias(out), "sessions")


def conversions_per_period(
    conversions: DataFrame,
    *,
    ts="created_at",
    amount="price_usd",
    period: str = "month",
    out: str = "year_month",
) -> DataFrame:
    """A2: conversions and revenue per period of the conversion's own time."""
    agg = _conversions_by_key(conversions, ts, amount, period)
    return agg.select(
        period_label(_KEY, period).alias(out),
        "orders",
        "revenue",
    )


def fill_missing(df: DataFrame, values: dict | None = None) -> DataFrame:
    """P5: NULL (and NaN) after an outer join -> 0 for counts and amounts."""
    return df.fillna(values or {"orders": 0, "revenue": 0.0})


def period_counts(
    visits: DataFrame,
    conversions: DataFrame,
    *,
    visit_time="created_at",
    conversion_time="created_at",
    amount="price_usd",
    period: str = "month",
    out: str = "year_month",
) -> DataFrame:
    """J1 + P5: visit periods left-joined to conversion periods.

    Periods with conversions but no visit are dropped; the NULL period never
    matches, so it keeps 0 conversions.
    """
    v = _visits_by_key(visits, visit_time, period)
    c = _conversions_by_key(conversions, conversion_time, amount, period)
    joined = v.join(c, on=_KEY, how="left").select(
        period_label(_KEY, period).alias(out),
        "sessions",
        "orders",
        "revenue",
    )
    return fill_missing(joined)


def period_trend(
    visits: DataFrame,
    conversions: DataFrame,
    *,
    visit_time="created_at",
    conversion_time="created_at",
    amount="price_usd",
    period: str = "month",
    out: str = "year_month",
    sort: bool = True,
) -> DataFrame:
    """O1: one row per period that has at least one visit.

    Columns: ``<out>, sessions, orders, revenue, conversion_rate_pct,
    aov_usd``; conversion is ``round(orders / sessions * 100, 2)`` and AOV is
    ``round(revenue / orders, 2)``, NULL without orders. Sorted by period,
    NULL first.

    ``period`` is ``"year"``, ``"month"`` or ``"day"``, or a
    ``date_format`` pattern. ``sort=False`` leaves the order to the reader
    (a table that is written and re-read has none).
    """
    counts = period_counts(
        visits,
        conversions,
        visit_time=visit_time,
        conversion_time=conversion_time,
        amount=amount,
        period=period,
        out=out,
    )
    trend = counts.select(
        out,
        "sessions",
        "orders",
        "revenue",
        pct("orders", "sessions").alias("conversion_rate_pct"),
        ratio("revenue", "orders").alias("aov_usd"),
    )
    return trend.orderBy(out) if sort else trend
