"""Dense positions in a global order.

The rows are sorted over many tasks (range partitions) and written once with the
number of their partition and their place in it. Positions then need the rows per
partition only: prefix sums of those counts, one number a partition, are the
offsets that turn places into positions 1..n without gaps. No task sees more than
its own partition, and no window runs over the whole table.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import written_once

_PART, _PLACE = "_part", "_place"
#: ``monotonically_increasing_id`` keeps the row's place in the lower bits.
_PLACE_BITS = 33


def with_positions(df: DataFrame, *order: Column | str, out: str = "position") -> DataFrame:
    """``df`` with ``out`` (bigint, 1..n) in the order of ``order``; rows that are
    equal in ``order`` come one after another in any order. Without ``order`` the
    rows keep the order the frame already has (a frame that ends in a sort)."""
    ordered = df.orderBy(*order) if order else df
    placed = written_once(
        ordered.withColumn(_PLACE, F.monotonically_increasing_id()).select(
            "*", F.shiftright(_PLACE, _PLACE_BITS).cast("int").alias(_PART)
        ),
        "positions",
    )
    # one row a sorted partition, however many rows there are
    counts = sorted((r[_PART], r["count"]) for r in placed.groupBy(_PART).count().collect())
    offsets = [(part, before) for (part, _), before in zip(counts, accumulate([0] + [n for _, n in counts]))]
    table = df.sparkSession.createDataFrame(offsets, f"{_PART} int, _before long")
    place = F.col(_PLACE).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    names = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    return placed.join(F.broadcast(table), _PART).select(*names, (F.col("_before") + place + 1).alias(out))
