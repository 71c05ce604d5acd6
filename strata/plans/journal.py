"""Journal of finished steps, so that a run can go on where it stopped.

A unit of work is one table of one layer. When it is finished, its fingerprint (of
its inputs' content and of all settings that its result depends on) and its audit
row are written to a small table of its own under the journal folder. A later run
that finds the same fingerprint, and the table in place, takes the audit row and
does not run the unit again. The entry goes before the unit starts and comes back
when it is done, so a unit that was killed half-way has none.

Inputs are fingerprinted by content, not by time: the landed files by their
SHA-256 digests, later layers by the fingerprints of what they are made from.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.files import path_exists

#: Part of every fingerprint: raise it when a step's result changes for the same
#: inputs and settings.
VERSION = 1
_SCHEMA = "fingerprint string, row string"


def fingerprint(*parts) -> str:
    """A digest of JSON-like values (mappings by key, anything else as text)."""
    return hashlib.sha256(json.dumps([VERSION, *parts], sort_keys=True, default=str).encode()).hexdigest()


def manifest_fingerprints(tables: DataFrame) -> dict[str, str]:
    """Per table the digest of its landed files: their places in the table and
    contents, whatever their order. One row a table reaches the driver."""
    row = F.xxhash64(F.substring("target", F.length("entry") + 1, F.lit(1 << 30)), "bytes", "sha256", "header")
    found = tables.groupBy("table").agg(
        F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("s"), F.bit_xor(row).alias("x"),
        F.bit_xor(F.xxhash64(F.lit("content"), "whole_sha256")).alias("w"),
    )
    return {r["table"]: fingerprint(r["n"], str(r["s"]), r["x"], r["w"]) for r in found.collect()}


class Journal:
    """Entries under ``folder``; ``resume=False`` forgets nothing and skips nothing
    but still records what it does."""

    def __init__(self, spark: SparkSession, folder: str, resume: bool):
        self.spark, self.folder, self.resume = spark, folder.rstrip("/"), resume

    def _path(self, unit: str) -> str:
        return f"{self.folder}/{hashlib.sha256(unit.encode()).hexdigest()[:32]}"

    def _forget(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def run(self, unit: str, mark: str, made: str, work: Callable[[], tuple]) -> tuple:
        """The audit row of ``unit``: the recorded one if ``mark`` is its
        fingerprint and the table ``made`` is there, else that of ``work()``."""
        path = self._path(unit)
        if path_exists(self.spark, f"{path}/_SUCCESS"):
            if self.resume and path_exists(self.spark, f"{made}/_SUCCESS"):
                entry = self.spark.read.schema(_SCHEMA).parquet(path).first()
                if entry and entry["fingerprint"] == mark:
                    return tuple(json.loads(entry["row"]))
            self._forget(path)
        row = work()
        entry = self.spark.createDataFrame([(mark, json.dumps(row))], _SCHEMA)
        entry.coalesce(1).write.mode("overwrite").parquet(path)
        return row
