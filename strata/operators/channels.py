"""Channel performance.

Attribution joins conversions to the visit they belong to. At scale that
join is the expensive step, so the conversion side is first reduced to one
row per visit id (count and exact revenue). The partial aggregate runs
before the shuffle, which also defuses a hot visit id on that side: a key
holding a third of all conversions leaves each map task as a single row.
The per-visit table comes out hash-partitioned on the join key, so the join
shuffles only the visit side; AQE may still switch to a broadcast join when
the measured size of one side allows.

A visit id repeated across a large share of the *visits* would send all of
them to one join task. ``lookup.attach`` keeps such ids, and visits without an
id, out of that: their totals, one row an id and taken from the per-visit
aggregate (no conversion is copied), reach their visits by a bounded broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.channels import (
    CHANNEL_TYPES,
    acquisition_type,
    channel_label,
    referer_host,
)
from strata.functions.ratios import double_part, exact_part, pct, ratio, total
from strata.operators.lookup import SALT, attach, hot_keys, no_salt, shuffle_partitions  # noqa: F401



def label_visits(
    visits: DataFrame,
    *,
    source="utm_source",
    campaign="utm_campaign",
    referer="http_referer",
    unknown_label: str | None = None,
) -> DataFrame:
    """Add ``channel_type`` (F2) and ``channel`` (F5) to each visit.

    The referrer host (F3) is computed in a projection of its own first, so
    the pattern is matched once per visit even though the label uses it
    twice (Spark keeps a non-trivial expression in its own projection rather
    than copying it into each use), and only for visits without a source
    (paid visits never show their referrer).
    """
    host = "_referer_host"
    unpaid = (F.col(source) if isinstance(source, str) else source).isNull()
    return (
        visits.withColumn(host, F.when(unpaid, referer_host(referer)))
        .withColumns(
            {
                "channel_type": acquisition_type(source, referer),
                "channel": channel_label(
                    source, campaign, referer, unknown_label=unknown_label, host=host
                ),
            }
        )
        .drop(host)
    )


def channel_sessions(labeled: DataFrame) -> DataFrame:
    """A3: visits per (channel, channel_type)."""
    return labeled.groupBy("channel", "channel_type").agg(F.count(F.lit(1)).alias("sessions"))


def _conversion_sums(amount) -> list:
    return [
        F.count(F.lit(1)).alias("orders"),
        F.sum(exact_part(amount)).alias("_exact"),
        F.sum(double_part(amount)).alias("_double"),
    ]


def conversions_per_visit(
    conversions: DataFrame, *, visit_id="website_session_id", amount="price_usd"
) -> DataFrame:
    """Conversions and the two parts of their revenue (see ``ratios``) per
    visit id."""
    return conversions.groupBy(visit_id).agg(*_conversion_sums(amount))


def _attach_conversions(
    labeled: DataFrame,
    conversions: DataFrame,
    *,
    visit_id,
    amount,
    how: str,
    salt_hot_visits: bool,
) -> DataFrame:
    """Visits joined to their per-visit ``orders`` and revenue parts (``how``
    is ``left`` or ``inner``), apart from hot and missing visit ids."""
    if not salt_hot_visits:
        per_visit = conversions_per_visit(conversions, visit_id=visit_id, amount=amount)
        return labeled.join(per_visit, on=visit_id, how=how)
    per_visit = (
        conversions.where(F.col(visit_id).isNotNull())
        .withColumn(SALT, no_salt(visit_id))
        .groupBy(visit_id, SALT)
        .agg(*_conversion_sums(amount))
    )
    return attach(labeled, per_visit, visit_id, how=how)


def channel_orders(
    labeled: DataFrame,
    conversions: DataFrame,
    *,
    visit_id="website_session_id",
    amount="price_usd",
    salt_hot_visits: bool = True,
) -> DataFrame:
    """P4 + J2 + A4: conversions and revenue per channel.

    Inner join on the visit id: conversions with an unknown or NULL visit are
    dropped; a visit id present twice counts its conversions twice.
    """
    visits = labeled.select(visit_id, "channel")
    return (
        _attach_conversions(visits, conversions, visit_id=visit_id, amount=amount,
                            how="inner", salt_hot_visits=salt_hot_visits)
        .groupBy("channel")
        .agg(
            F.sum("orders").alias("orders"),
            total(F.sum("_exact"), F.sum("_double")).alias("revenue"),
        )
    )


def _finish(df: DataFrame, sort: bool = True) -> DataFrame:
    """P5 + F6 + F8 + P3 + T2 on (channel, channel_type, sessions, orders,
    revenue)."""
    filled = df.fillna({"orders": 0, "revenue": 0.0})
    table = filled.select(
        "channel",
        "channel_type",
        "sessions",
        "orders",
        pct("orders", "sessions").alias("conversion_rate_pct"),
        "revenue",
        ratio("revenue", "sessions").alias("revenue_per_session_usd"),
    )
    if not sort:
        return table
    return table.orderBy(F.desc("revenue"), F.asc_nulls_last("channel"), F.asc("channel_type"))


def join_channel_totals(sessions_by_channel: DataFrame, orders_by_channel: DataFrame) -> DataFrame:
    """Left join of ``channel_sessions`` and ``channel_orders`` on the
    channel alone, then fill, ratios and order.

    A NULL channel never matches, so its conversions show as 0.
    """
    return _finish(sessions_by_channel.join(orders_by_channel, on="channel", how="left"))


def channel_performance(
    visits: DataFrame,
    conversions: DataFrame,
    *,
    visit_id="website_session_id",
    amount="price_usd",
    source="utm_source",
    campaign="utm_campaign",
    referer="http_referer",
    unknown_label: str | None = None,
    salt_hot_visits: bool = True,
    sort: bool = True,
) -> DataFrame:
    """O2: one row per (channel, channel_type), sorted by revenue
    (``sort=False`` leaves the order to the reader).

    Same result as ``join_channel_totals(channel_sessions(...),
    channel_orders(...))`` but in one pass over the visits and one
    aggregate: each visit is labelled once and left-joined to its per-visit
    conversions, then grouped by channel alone, counting visits per
    acquisition type (a closed set of three) with conditional counts. Each
    channel then yields one row per type it has visits of, all carrying the
    channel's conversions (the J3 join is on the channel alone); a NULL
    channel gets 0, as the NULL key of that join would give.

    ``salt_hot_visits`` looks for visit ids repeated across a large share of
    the visits and spreads them over several join tasks (see the module
    notes); ``False`` joins without that pass. The result does not depend
    on it.
    """
    labeled = label_visits(
        visits, source=source, campaign=campaign, referer=referer, unknown_label=unknown_label
    ).select(visit_id, "channel", "channel_type")
    kind = F.col("channel_type")
    per_channel = (
        _attach_conversions(labeled, conversions, visit_id=visit_id, amount=amount,
                            how="left", salt_hot_visits=salt_hot_visits)
        .groupBy("channel")
        .agg(
            *[F.count(F.when(kind == t, F.lit(1))).alias(f"_v{i}")
              for i, t in enumerate(CHANNEL_TYPES)],
            F.sum("orders").alias("_orders"),
            total(F.sum("_exact"), F.sum("_double")).alias("_revenue"),
        )
    )
    per_type = F.array(
        *[F.struct(F.lit(t).alias("channel_type"), F.col(f"_v{i}").alias("sessions"))
          for i, t in enumerate(CHANNEL_TYPES)]
    )
    known = F.col("channel").isNotNull()
    rows = (
        per_channel.select("channel", "_orders", "_revenue", F.inline(per_type))
        .where(F.col("sessions") > 0)
        .select(
            "channel",
            "channel_type",
            "sessions",
            F.when(known, F.col("_orders")).alias("orders"),
            F.when(known, F.col("_revenue")).alias("revenue"),
        )
    )
    return _finish(rows, sort)
