"""The five-step layered pipeline.

1. bronze     raw CSV files copied byte for byte (``land_files``)
2. silver     each CSV table typed, cleaned and written as Parquet
3. gold       period trend and channel performance from two silver tables
4. warehouse  silver and gold tables loaded over JDBC (only with a URL);
              with ``register=True`` all layers are also registered in
              Spark's catalog as ``silver.<t>``, ``gold.<t>``, ``report.<t>``
5. report     report figures and tables computed from gold, as Parquet

Steps hand over through storage only: each step reads what the previous
one wrote, which also cuts the lineage between steps. Every write returns
its row count from the write job itself. A failing step stops the run, and so
does a table that gold needs and this run has not written: tables left from
earlier runs are never taken for it.

Every table that is finished is noted in a journal (``<lake>/_journal``) with a
fingerprint of its inputs and settings. ``resume=True`` takes such tables as they
are: a run that was stopped goes on where it stopped, and a run after a change
copies the changed files and makes anew only what depends on them.
Within a step, the tables are independent jobs submitted from a few driver
threads at once, so small tables do not leave the cluster idle; each table
is one distributed job.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.config import Config
from strata.operators import insights as ins
from strata.operators.channels import channel_performance
from strata.operators.positions import with_positions
from strata.operators.silver import UNPARSED, clean
from strata.operators.trend import period_trend
from strata.sinks.jdbc import load_layer
from strata.plans.journal import Journal, fingerprint, manifest_fingerprints
from strata.sinks.landing import PART_BYTES, land_files, set_aside
from strata.sinks.parquet import write_observed, write_verified
from strata.sources.csv import read_table as read_csv_table
from strata.sources.files import lake_tables, path_exists, qualified, with_table
from strata.sources.lake import read_table, register_layer

AUDIT_SCHEMA = (
    "step int, layer string, table string, rows long, origin string, key string, "
    "unparsed long, conversions long, bad_cells long"
)


def _row(step, layer, table, rows, origin=None, key=None, unparsed=None, conversions=None, bad_cells=None):
    """One audit row: ``rows`` written; silver rows add the origin tag, key,
    unparsed timestamps and cells that did not fit the declared schema; gold rows
    add the conversions they account for (silver conversions minus this is what
    the gold table dropped)."""
    extra = ", ".join(
        f"{k}={v}" for k, v in
        (("schema", origin), ("key", key), ("unparsed", unparsed), ("conversions", conversions), ("bad cells", bad_cells))
        if v is not None
    )
    log.info("step %d %s/%s: %s rows%s", step, layer, table, rows, f" ({extra})" if extra else "")
    return (step, layer, table, rows, origin, key, unparsed, conversions, bad_cells)


STALE = "stale"
BAD = "_bad_cells"

log = logging.getLogger("strata.pipeline")

# Gold and report table names (fixed values of the reference's lake layout).
GOLD_MONTHLY = "gold_monthly_trend"
GOLD_CHANNELS = "gold_channel_performance"


@dataclass(frozen=True)
class Layers:
    """Folders of the four layers and of the journal (any Hadoop-FS URI)."""
    bronze: str
    silver: str
    gold: str
    report: str
    journal: str | None = None

    @classmethod
    def under(cls, root: str) -> Layers:
        r = root.rstrip("/")
        return cls(f"{r}/bronze", f"{r}/silver", f"{r}/gold", f"{r}/report", f"{r}/_journal")


def _concurrently(jobs: dict[str, Callable], workers: int) -> dict:
    """Run independent Spark jobs from ``workers`` driver threads; results
    in the order of ``jobs``; the first failure (in that order) is raised."""
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        futures = {k: pool.submit(f) for k, f in jobs.items()}
        return {k: f.result() for k, f in futures.items()}


@dataclass(frozen=True)
class Source:
    """What silver reads for a table: its bronze file or folder, and the
    fingerprint of what was landed there."""
    path: str
    content: str


def bronze_step(
    spark: SparkSession, raw: str, layers: Layers, config: Config = Config(), *,
    split_bytes: int | None = None, changed_only: bool = False,
) -> dict[str, Source]:
    """Step 1: land the raw files; return, per table, its bronze file or folder.

    Files in such a folder that are not in this run's manifest (parts of an
    earlier run) are moved aside there under a hidden name, found by an anti-join
    of the folder's listing with the manifest, so silver reads this run's files by
    naming the folder: no list of files reaches the driver.

    Tables come from the landing's own manifest (no second listing); two
    raw entries with one table name (``a.csv`` and ``a.CSV``) fail, and so do
    CSV files in a folder that is no table. Files over ``split_bytes`` are landed
    in ranges, except those of tables whose CSV options say that a line is no
    record (``multiLine``, ``lineSep``), that there is no header, or that the text
    is not in UTF-8.
    """
    raw_q, bronze_q = qualified(spark, raw), qualified(spark, layers.bronze)
    before = path_exists(spark, bronze_q)
    landed = land_files(
        spark, raw_q, bronze_q, split_bytes=split_bytes, uncut=_uncut(raw_q, config), changed_only=changed_only
    )
    tables = with_table(landed, bronze_q, "target")
    stray = landed.join(tables.select("target"), "target", "left_anti").first()
    if stray:
        raise ValueError(f"{stray['source']} lies in a folder that is no table (its name has no .csv)")
    log.info("step 1 bronze: raw files of %s landed in %s", raw_q, bronze_q)
    entries = tables.groupBy("table", "entry").agg(F.count(F.lit(1)).alias("files")).collect()
    if not entries:
        raise FileNotFoundError(f"no CSV found in {raw}")
    seen: dict[str, str] = {}
    for r in sorted(entries, key=lambda r: (r["table"], r["entry"])):
        if r["table"] in seen:
            raise ValueError(
                f"table {r['table']!r} has two raw entries: {seen[r['table']]} and {r['entry']}"
            )
        seen[r["table"]] = r["entry"]
    if before:
        set_aside(spark, bronze_q, landed, seen.values())
    content = manifest_fingerprints(tables)
    return {t: Source(_literal(entry), content[t]) for t, entry in seen.items()}


def _uncut(raw_q: str, config: Config) -> Column:
    """Whether a raw file belongs to a table whose files must stay whole."""

    def whole(options: dict) -> bool:
        found = {k.lower(): str(v).lower() for k, v in options.items()}
        return (
            found.get("multiline", "false") == "true" or "linesep" in found or found.get("header", "true") == "false"
            or not {found.get("encoding", "utf-8"), found.get("charset", "utf-8")} <= {"utf-8", "utf8"}
        )

    common = dict(config.defaults.csv_options)
    if whole(common):
        return F.lit(True)
    names = [t for t, spec in config.tables.items() if whole({**common, **dict(spec.options)})]
    first = F.split(F.substring(F.col("source"), len(raw_q) + 2, 1 << 30), "/").getItem(0)
    return F.regexp_extract(first, r"^(.+)\.[cC][sS][vV]$", 1).isin(names) if names else F.lit(False)


def _literal(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\\{}\[\]*?^])", r"\\\1", path)


def silver_step(
    spark: SparkSession, sources: dict[str, Source], layers: Layers, config: Config, workers: int = 4,
    journal: Journal | None = None, verify: bool = False,
) -> list[tuple]:
    """Step 2: CSV -> typed, de-duplicated, keyed Parquet.

    Besides the rows written, the audit counts the timestamps set in the
    CSV that did not parse and are NULL in silver, and the cells that did not fit
    a declared schema and are NULL there, both observed by the same write.
    ``verify`` reads each table back and compares its content. An empty CSV without a declaration has no columns; it is
    recorded with 0 rows and no table is written. Silver tables left from earlier runs whose raw file is gone are
    listed as ``stale``; they are kept.
    """
    d = config.defaults

    write = write_verified if verify else write_observed

    def one(table: str, path: str) -> tuple:
        spec = config.spec(table)
        df, origin = read_csv_table(spark, path, spec, d, {"recursiveFileLookup": True}, bad=BAD)
        if not df.columns:
            # An empty file read without a declaration has no columns, and a
            # table without columns cannot be written: recorded, not written.
            return _row(2, "silver", table, 0, origin, None, 0, None, 0)
        seen = Observation(f"bad_{uuid.uuid4().hex[:8]}")
        cleaned, key = clean(df, spec, d, mark=UNPARSED, bad=BAD, seen=seen)
        m = write(
            cleaned,
            f"{layers.silver}/{table}",
            drop=[UNPARSED],
            unparsed=F.coalesce(F.sum(UNPARSED), F.lit(0)).cast("long"),
        )
        return _row(2, "silver", table, int(m["rows"]), origin, key, int(m["unparsed"]), None, int(seen.get["bad_cells"]))

    jobs = {
        t: (lambda t=t, s=s: _noted(
            journal, f"silver/{t}", fingerprint(s.content, vars(config.spec(t)), vars(d), verify),
            f"{layers.silver}/{t}", lambda: one(t, s.path)))
        for t, s in sources.items()
    }
    audit = list(_concurrently(jobs, workers).values())
    for table in lake_tables(spark, layers.silver):
        if table not in sources:
            audit.append(_row(2, "silver", table, None, STALE))
    return audit


def _noted(journal: Journal | None, unit: str, mark: str, made: str, work: Callable[[], tuple]) -> tuple:
    return journal.run(unit, mark, made, work) if journal else work()


def gold_step(
    spark: SparkSession,
    layers: Layers,
    *,
    visits: str = "website_sessions",
    conversions: str = "orders",
    workers: int = 4,
    journal: Journal | None = None,
    inputs: str = "",
    **columns,
) -> list[tuple]:
    """Step 3: the two gold tables from the visit and conversion tables;
    ``inputs`` is the fingerprint of these."""
    v = read_table(spark, layers.silver, visits)
    c = read_table(spark, layers.silver, conversions)
    trend_kw = {k: columns[k] for k in ("visit_time", "conversion_time", "amount") if k in columns}
    chan_kw = {k: columns[k] for k in ("visit_id", "amount", "source", "campaign", "referer")
               if k in columns}
    # Written unsorted: every reader orders them itself, so a sort here
    # would only add a sampling job and a shuffle.
    outputs = {
        GOLD_MONTHLY: lambda: period_trend(v, c, sort=False, **trend_kw),
        GOLD_CHANNELS: lambda: channel_performance(v, c, sort=False, **chan_kw),
    }
    attributed = F.coalesce(F.sum("orders"), F.lit(0)).cast("long")
    mark = fingerprint(inputs, visits, conversions, columns)
    return _write_all(outputs, layers.gold, 3, "gold", workers, journal, mark, conversions=attributed)


def _write_all(
    outputs: dict[str, Callable[[], DataFrame]], folder: str, step: int, layer: str, workers: int,
    journal: Journal | None = None, mark: str = "", **metrics,
) -> list[tuple]:
    """Write independent tables concurrently (a table the journal has is not even
    planned); audit rows in the given order."""

    def one(name: str, make: Callable[[], DataFrame]) -> tuple:
        m = write_observed(make(), f"{folder}/{name}", **metrics)
        return _row(step, layer, name, int(m["rows"]), conversions=m.get("conversions"))

    jobs = {
        name: (lambda name=name, make=make: _noted(
            journal, f"{layer}/{name}", mark, f"{folder}/{name}", lambda: one(name, make)))
        for name, make in outputs.items()
    }
    return list(_concurrently(jobs, workers).values())


def catalog_step(spark: SparkSession, layers: Layers, move: bool = False) -> list[tuple]:
    """Step 4 without a database: silver, gold and report tables registered
    in Spark's catalog as ``silver.<t>``, ``gold.<t>``, ``report.<t>``;
    ``move`` lets names follow a lake that was moved."""
    audit = []
    for layer, database in ((layers.silver, "silver"), (layers.gold, "gold"),
                            (layers.report, "report")):
        for name in register_layer(spark, layer, database, move=move):
            audit.append(_row(4, "catalog", f"{database}.{name}", None))
    return audit


def warehouse_step(
    spark: SparkSession, layers: Layers, url: str, properties=None, connections: int = 8,
    schemas=("silver", "gold"),
) -> list[tuple]:
    """Step 4: silver and gold layers into the database schemas of the same
    names, each table written over at most ``connections`` connections."""
    audit = []
    for schema in schemas:
        layer = getattr(layers, schema)
        for name, rows in load_layer(
            spark, layer, schema, url, properties, num_partitions=connections
        ):
            audit.append(_row(4, "warehouse", f"{schema}.{name}", rows))
    return audit


def report_step(
    spark: SparkSession, layers: Layers, workers: int = 4, journal: Journal | None = None, inputs: str = ""
) -> list[tuple]:
    """Step 5: report figures, chart series and tables from gold.

    Ordered outputs get a ``position`` column, 1..n in their order, so that the
    order survives storage (see ``operators.positions``). ``inputs`` is the
    fingerprint of the gold tables.
    """
    monthly = read_table(spark, layers.gold, GOLD_MONTHLY)
    channels = read_table(spark, layers.gold, GOLD_CHANNELS)
    ordered = {
        "trend_series": lambda: ins.trend_series(monthly),
        "channel_revenue_series": lambda: ins.channel_revenue_series(channels),
        "channel_conversion_series": lambda: ins.channel_conversion_series(channels),
        "channel_type_mix": lambda: ins.channel_type_mix(channels),
        "channel_table": lambda: ins.channel_table(channels),
        "type_table": lambda: ins.type_table(channels),
    }
    outputs = {"insight_summary": lambda: ins.insight_summary(monthly, channels)}
    outputs |= {name: (lambda make=make: with_positions(make())) for name, make in ordered.items()}
    return _write_all(outputs, layers.report, 5, "report", workers, journal, inputs)


def run_pipeline(
    spark: SparkSession,
    raw: str,
    layers: Layers,
    config: Config = Config(),
    *,
    visits: str = "website_sessions",
    conversions: str = "orders",
    jdbc_url: str | None = None,
    jdbc_properties=None,
    jdbc_connections: int = 8,
    workers: int = 4,
    register: bool = False,
    move_registered: bool = False,
    gold: bool = True,
    resume: bool = False,
    verify: bool = False,
    split_bytes: int | None = PART_BYTES,
    **columns,
) -> DataFrame:
    """Run the five steps; return the audit (``step, layer, table, rows,
    origin, key, unparsed, conversions, bad_cells``), one row per table.

    ``resume=True`` copies only raw files that changed and makes only tables
    whose inputs or settings changed since they were last finished (see
    ``plans.journal``); the audit is that of a full run. ``verify`` compares each
    silver table's content with what was written. Raw files over ``split_bytes``
    are landed in ranges (``None``: none is).

    ``register=True`` also registers the silver, gold and report tables in
    Spark's catalog (``silver.<t>``, ``gold.<t>``, ``report.<t>``);
    ``move_registered`` lets these names follow a lake that was moved.
    Silver is loaded into the database before gold is required. Raises
    ``FileNotFoundError`` naming the table if this run wrote no silver table
    for the visits or the conversions; ``gold=False`` stops after silver.
    """
    journal = Journal(spark, layers.journal, resume) if layers.journal else None
    sources = bronze_step(spark, raw, layers, config, split_bytes=split_bytes, changed_only=resume)
    audit = silver_step(spark, sources, layers, config, workers, journal, verify)

    def warehouse(schema: str) -> list[tuple]:
        if not jdbc_url:
            return []
        return warehouse_step(spark, layers, jdbc_url, jdbc_properties, jdbc_connections, (schema,))

    audit += warehouse("silver")
    if gold:
        written = {r[2] for r in audit if r[1] == "silver" and r[5] is not None}
        missing = sorted({visits, conversions} - written)
        if missing:
            raise FileNotFoundError(f"gold needs {', '.join(missing)}, which this run did not write to {layers.silver}")
        inputs = fingerprint(*[
            (t, sources[t].content, vars(config.spec(t)), vars(config.defaults), verify) for t in (visits, conversions)
        ])
        audit += gold_step(
            spark, layers, visits=visits, conversions=conversions, workers=workers, journal=journal, inputs=inputs,
            **columns,
        )
        audit += warehouse("gold")
        audit += report_step(spark, layers, workers, journal, fingerprint(inputs, visits, conversions, columns))
    if register:
        audit += catalog_step(spark, layers, move_registered)
    return spark.createDataFrame(audit, AUDIT_SCHEMA)
