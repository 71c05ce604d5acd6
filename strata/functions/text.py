"""Text for reports: number formats and trend words.

``format_number`` uses Java's DecimalFormat, which rounds the exact binary
value half-even, the same rule as Python's ``format``; so ``{x:,.2f}`` and
``{x:.2f}`` style texts come out identical.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._cols import as_col

# ---------------------------------------------------------------------------
# Report words that must equal the reference's output.
# ---------------------------------------------------------------------------
UP = "en hausse"
DOWN = "en baisse"
IMPROVING = "en progression"
WORSENING = "en recul"
# ---------------------------------------------------------------------------


def _format(x, pattern: str) -> Column:
    # The SQL form of format_number takes a DecimalFormat pattern.
    return F.call_function("format_number", as_col(x), F.lit(pattern))


def grouped(x, digits: int = 2) -> Column:
    """``1234.5 -> "1,234.50"`` (Python ``{x:,.2f}``)."""
    pattern = "#,##0" + ("." + "0" * digits if digits > 0 else "")
    return _format(x, pattern)


def plain(x, digits: int = 2) -> Column:
    """``1234.5 -> "1234.50"`` (Python ``{x:.2f}``)."""
    pattern = "0" + ("." + "0" * digits if digits > 0 else "")
    return _format(x, pattern)


def percent_text(x, digits: int = 2) -> Column:
    """``12.3 -> "12.30%"``."""
    return F.concat(plain(x, digits), F.lit("%"))


def thousands_usd(x) -> Column:
    """``123456 -> "$123k"`` (Python ``f"${v/1000:,.0f}k"``)."""
    return F.concat(F.lit("$"), grouped(as_col(x) / F.lit(1000), 0), F.lit("k"))


def direction(x, up: str = UP, down: str = DOWN) -> Column:
    """``up`` when ``x >= 0``, else ``down``. NULL and NaN take ``down``, as
    a NaN comparison does in Python (Spark orders NaN above every number,
    so it is tested first)."""
    v = as_col(x)
    return F.when(F.isnan(v), F.lit(down)).when(v >= 0, F.lit(up)).otherwise(F.lit(down))
