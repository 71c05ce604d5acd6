"""Period figures that grow by batches (A1, A2, O1).

A batch of visits or conversions is reduced once to exact partial sums, one row a
period: visits, conversions, and the two parts of their revenue (decimal and
double, see ``functions.ratios``). Such states merge by adding, in any order and
grouping, so a late batch costs one scan of that batch and a merge of small tables,
and the trend over all batches equals the trend over all rows at once.

``PeriodStore`` keeps the state of every batch in a folder of its own, named by the
batch. A batch that is delivered again, or corrected, replaces its state instead of
being counted twice; a write that failed leaves no state.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.periods import period_key, period_label
from strata.functions.ratios import double_part, exact_part, pct, ratio, total
from strata.operators.trend import fill_missing
from strata.sinks.parquet import write_table
from strata.sources.files import lake_tables

KEY = "_period"
_COLUMNS = ("sessions", "orders", "_exact", "_double")
_EXACT = "decimal(38,12)"


def visit_state(visits: DataFrame, *, ts="created_at", period: str = "month") -> DataFrame:
    """The state of a batch of visits."""
    counted = visits.groupBy(period_key(ts, period).alias(KEY)).agg(F.count(F.lit(1)).alias("sessions"))
    return counted.select(
        KEY, "sessions", F.lit(0).cast("long").alias("orders"),
        F.lit(None).cast(_EXACT).alias("_exact"), F.lit(None).cast("double").alias("_double"),
    )


def conversion_state(conversions: DataFrame, *, ts="created_at", amount="price_usd", period: str = "month") -> DataFrame:
    """The state of a batch of conversions."""
    summed = conversions.groupBy(period_key(ts, period).alias(KEY)).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(exact_part(amount)).cast(_EXACT).alias("_exact"),
        F.sum(double_part(amount)).alias("_double"),
    )
    return summed.select(KEY, F.lit(0).cast("long").alias("sessions"), "orders", "_exact", "_double")


def merged(states: DataFrame) -> DataFrame:
    """States of several batches, as one state."""
    return states.groupBy(KEY).agg(
        F.sum("sessions").alias("sessions"), F.sum("orders").alias("orders"),
        F.sum("_exact").cast(_EXACT).alias("_exact"), F.sum("_double").alias("_double"),
    )


def trend_of(state: DataFrame, *, period: str = "month", out: str = "year_month", sort: bool = True) -> DataFrame:
    """O1 of a merged state: the rows of ``trend.period_trend``. Periods without a
    visit are left out; the NULL period has no conversions."""
    known = F.col(KEY).isNotNull()
    shown = state.where("sessions > 0").select(
        period_label(KEY, period).alias(out),
        "sessions",
        F.when(known, F.col("orders")).alias("orders"),
        F.when(known, total("_exact", "_double")).alias("revenue"),
    )
    trend = fill_missing(shown).select(
        out, "sessions", "orders", "revenue",
        pct("orders", "sessions").alias("conversion_rate_pct"), ratio("revenue", "orders").alias("aov_usd"),
    )
    return trend.orderBy(out) if sort else trend


class PeriodStore:
    """The states of batches under ``folder``; all of one ``period``."""

    def __init__(self, spark: SparkSession, folder: str, *, period: str = "month"):
        self.spark, self.folder, self.period = spark, folder.rstrip("/"), period

    def _path(self, batch: str) -> str:
        return f"{self.folder}/batch-{hashlib.sha256(batch.encode()).hexdigest()[:32]}"

    def put(self, batch: str, visits: DataFrame | None = None, conversions: DataFrame | None = None, **columns) -> int:
        """Store the state of ``batch`` (in place of an earlier state of that
        name); returns its number of periods. ``columns``: ``visit_time``,
        ``conversion_time``, ``amount``."""
        states = []
        if visits is not None:
            states.append(visit_state(visits, ts=columns.get("visit_time", "created_at"), period=self.period))
        if conversions is not None:
            states.append(
                conversion_state(
                    conversions, ts=columns.get("conversion_time", "created_at"),
                    amount=columns.get("amount", "price_usd"), period=self.period,
                )
            )
        if not states:
            raise ValueError("a batch needs visits or conversions")
        state = merged(states[0] if len(states) == 1 else states[0].unionByName(states[1]))
        return write_table(state.repartition(1), self._path(batch))  # one row a period is left by then

    def state(self) -> DataFrame:
        """All batches together."""
        batches = lake_tables(self.spark, self.folder)
        if not batches:
            raise FileNotFoundError(f"no batch in {self.folder}")
        return merged(self.spark.read.parquet(*[f"{self.folder}/{b}" for b in batches]))

    def trend(self, *, out: str = "year_month", sort: bool = True) -> DataFrame:
        """O1 over all rows of all batches."""
        return trend_of(self.state(), period=self.period, out=out, sort=sort)
