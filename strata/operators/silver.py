"""Silver cleaning.

``clean`` = timestamp cast -> exact-duplicate removal -> key not NULL.
Catalyst pushes the key filter below the duplicate removal and into the
scan; the duplicate removal is one hash aggregate on all columns, whose
map-side half collapses repeated rows before the shuffle (a row repeated
across a third of the input leaves each task once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strata.config import Defaults, TableSpec
from strata.session import written_once


UNPARSED = "_unparsed"


def cast_timestamps(
    df: DataFrame, columns, fmt: str = Defaults.timestamp_format, *, mark: str | None = None
) -> DataFrame:
    """Parse the listed columns that exist and are still text.

    A value that does not match ``fmt`` becomes NULL (``try_to_timestamp``)
    rather than failing the job; a column already read as a timestamp or
    date is left alone. With ``mark``, a column of that name counts, per
    row, the values that were set but did not parse.
    """
    types = dict(df.dtypes)
    todo = [c for c in columns if types.get(c) == "string"]
    parsed = {c: F.try_to_timestamp(F.col(c), F.lit(fmt)) for c in todo}
    if mark is not None:
        bad = [(F.col(c).isNotNull() & parsed[c].isNull()).cast("int") for c in todo]
        parsed[mark] = sum(bad[1:], bad[0]) if bad else F.lit(0)
    return df.withColumns(parsed) if parsed else df


def drop_exact_duplicates(df: DataFrame, *, total: str | None = None) -> DataFrame:
    """A5: keep one copy of rows equal in every column (NULLs equal). With
    ``total``, that column is no part of the comparison; the copy that stays
    carries its sum over the equal rows."""
    if total is None:
        return df.dropDuplicates()
    rest = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c != total]
    return df.groupBy(*rest).agg(F.sum(total).alias(total)).select(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def drop_wide_duplicates(df: DataFrame, *, most: int = 1 << 20) -> DataFrame:
    """A5 for wide rows with few duplicates: the rows of ``drop_exact_duplicates``
    without shuffling whole rows.

    Only a 128-bit digest of each row is shuffled. Rows whose digest occurs once
    are unique and stay where they are; the others, found by a join with the
    repeated digests, are compared in full. Two different rows of one digest are
    both kept, so a collision costs time, not rows. ``df`` is read three times: give it
    a table, not a costly computation. With more than ``most`` repeated digests
    (16 bytes each; the list is broadcast) rows are shuffled whole instead: then
    the aggregate removes much before the shuffle anyway.
    """
    cells = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    nulls = F.concat(F.lit(""), *[c.isNull().cast("int").cast("string") for c in cells])
    halves = {f"_digest{i}": F.xxhash64(F.lit(i), nulls, *cells) for i in (0, 1)}
    keyed = df.withColumns(halves)
    repeated = written_once(
        keyed.select(*halves).groupBy(*halves).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*halves),
        "repeated-digests",
    )
    if repeated.limit(most + 1).count() > most:
        return drop_exact_duplicates(df)
    listed = F.broadcast(repeated.withColumn("_listed", F.lit(True)))
    marked = keyed.join(listed, list(halves), "left")
    unique = marked.where(F.col("_listed").isNull()).select(*cells)
    return unique.unionAll(drop_exact_duplicates(marked.where("_listed").select(*cells)))


def resolve_key(df: DataFrame, spec: TableSpec | None = None) -> str | None:
    """The declared key, else the first column (None for a frame without
    columns, such as an empty CSV read without a declaration)."""
    return (spec.primary_key if spec else None) or (df.columns[0] if df.columns else None)


def require_key(df: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key is NULL. A key that is not a column (exact,
    case-sensitive name) leaves the frame as it is."""
    return df.where(F.col(key).isNotNull()) if key and key in df.columns else df


def clean(
    df: DataFrame,
    spec: TableSpec | None = None,
    defaults: Defaults = Defaults(),
    *,
    mark: str | None = None,
    bad: str | None = None,
    seen: Observation | None = None,
) -> tuple[DataFrame, str]:
    """O3: the silver table of a raw frame; returns it and its key.

    With ``mark``, the frame carries a column of that name counting each
    row's unparsed timestamps (see ``cast_timestamps``); the column is a
    function of the row, so it does not change which rows are duplicates.

    ``bad`` names a column of ``df`` that counts each row's cells that did not fit
    the schema. It is summed through the duplicate removal and observed by
    ``seen`` (as ``bad_cells``) before rows without a key go, so a spoiled key is
    counted too, in the same stage that writes the table.
    """
    out = cast_timestamps(df, defaults.timestamp_columns, defaults.timestamp_format, mark=mark)
    if defaults.drop_duplicates:
        out = drop_exact_duplicates(out, total=bad)
    key = resolve_key(out, spec)
    if bad is not None:
        out = out.observe(seen, F.coalesce(F.sum(bad), F.lit(0)).cast("long").alias("bad_cells")).drop(bad)
    return require_key(out, key), key
