"""Calendar periods (F1).

A period is shown as text (``yyyy-MM`` for months). Grouping on that text
means formatting every input row; grouping on the truncated timestamp and
formatting once per group gives the same groups (the format is a function of
the truncated value) at a fraction of the per-row cost, so named periods go
that way. A free-form format falls back to grouping on the formatted text.
Both follow the session time zone for TIMESTAMP and ignore it for
TIMESTAMP_NTZ.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._cols import as_col

# name -> (date_trunc unit, display format). Only units whose truncation
# maps one-to-one onto the label in every time zone: an hour is not one of
# them (the repeated hour at a daylight-saving change is two instants with
# one label), so hours group on the text format "yyyy-MM-dd HH".
PERIODS = {
    "year": ("year", "yyyy"),
    "month": ("month", "yyyy-MM"),
    "day": ("day", "yyyy-MM-dd"),
}
MONTH_FORMAT = PERIODS["month"][1]


def period_text(ts, fmt: str = MONTH_FORMAT) -> Column:
    """Period label of a timestamp as text, e.g. ``2012-03``."""
    return F.date_format(as_col(ts), fmt)


def period_key(ts, period: str) -> Column:
    """Grouping key for ``period``: a truncated timestamp for a named
    period, else the formatted text (``period`` is then the format)."""
    if period in PERIODS:
        return F.date_trunc(PERIODS[period][0], as_col(ts))
    return period_text(ts, period)


def period_label(key, period: str) -> Column:
    """Text of a key made by :func:`period_key`."""
    if period in PERIODS:
        return F.date_format(as_col(key), PERIODS[period][1])
    return as_col(key)
