"""CSV scans for the silver step.

A raw table is a CSV file or a folder of CSV part files with a header row.
The literal null sentinel (``NULL`` by default) and empty unquoted fields
read as NULL; a quoted empty field stays an empty string. A cell that does
not parse as its declared type becomes NULL and the row is kept (Spark's
PERMISSIVE mode).

Declared schemas are checked against the header (``enforceSchema`` off):
Spark binds CSV columns by position, so a file whose header differs from
the declaration fails instead of loading values into the wrong columns. A
table option ``enforceSchema=true`` binds by position without that check.
Inferred schemas cost one extra pass over all of the data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.config import Defaults, TableSpec

# Origin tags of the load audit (fixed values of the reference's report).
DECLARED = "declare"
INFERRED = "infere"


def _reader(spark: SparkSession, null_value: str, options: Mapping | None):
    # A new reader per call: a reader keeps a schema set on it earlier.
    r = spark.read.option("header", True).option("nullValue", null_value)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r


def read_declared(
    spark: SparkSession, path: str, spec: TableSpec, defaults: Defaults = Defaults(), options=None, *,
    bad: str | None = None,
) -> DataFrame:
    """CSV with the declared schema; header names must match it.

    With ``bad``, a column of that name counts each row's cells that are set in
    the file but do not parse as their declared type and so are NULL here (a row
    with too few or too many cells counts as one at least). The reader keeps the
    text of such rows only, and only that text is looked at again."""
    options = {"enforceSchema": False, **dict(options or {})}
    schema = spec.schema()
    if bad is None:
        return _reader(spark, defaults.null_value, options).schema(schema).csv(path)
    line = "_line_that_does_not_fit"
    known = {**options, "columnNameOfCorruptRecord": line}
    df = _reader(spark, defaults.null_value, known).schema(schema.add(line, StringType())).csv(path)
    typed = [f for f in schema.fields if f.name != line]
    as_text = StructType([StructField(f"c{i}", StringType()) for i in range(len(typed))])
    raw = F.from_csv(F.col(line), as_text.simpleString()[len("struct<"):-1].replace(":", " "),
                     {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in {"nullValue": defaults.null_value, **options}.items()})
    df = df.withColumn("_raw", F.when(F.col(line).isNotNull(), raw))
    lost = [
        (F.col("_raw").getField(f"c{i}").isNotNull() & F.col("`" + f.name.replace("`", "``") + "`").isNull()).cast("int")
        for i, f in enumerate(typed)
    ]
    count = F.greatest(F.lit(1), sum(lost[1:], lost[0]))
    return df.withColumn(bad, F.when(F.col(line).isNull(), 0).otherwise(count)).drop(line, "_raw")


def read_inferred(
    spark: SparkSession,
    path: str,
    defaults: Defaults = Defaults(),
    options=None,
) -> DataFrame:
    """CSV with names from the header and types inferred from the data."""
    return _reader(spark, defaults.null_value, options).option("inferSchema", True).csv(path)


def read_table(
    spark: SparkSession,
    path: str | list[str],
    spec: TableSpec | None = None,
    defaults: Defaults = Defaults(),
    options=None,
    *,
    bad: str | None = None,
) -> tuple[DataFrame, str]:
    """Declared schema when the table declares columns, else inferred;
    returns the frame and its origin tag. ``bad`` as in ``read_declared``; types
    inferred from all cells fit all cells."""
    spec = spec or TableSpec()
    options = {**dict(defaults.csv_options), **dict(spec.options), **dict(options or {})}
    if spec.declared:
        return read_declared(spark, path, spec, defaults, options, bad=bad), DECLARED
    df = read_inferred(spark, path, defaults, options)
    return (df.withColumn(bad, F.lit(0)) if bad and df.columns else df), INFERRED


def write_csv(df: DataFrame, path: str, *, null_value: str = "NULL",
              timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> None:
    """Write a frame as raw CSV (header, null sentinel, timestamp text)."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", null_value)
        .option("timestampFormat", timestamp_format)
        .option("timestampNTZFormat", timestamp_format)
        .csv(path)
    )
