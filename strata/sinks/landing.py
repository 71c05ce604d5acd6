"""Bronze landing: copy of raw files without loss (K1).

The copy is a Spark job over byte ranges. A file of one range is copied and hashed
by one task. A larger one is landed in one of two ways:

* **cut** (``split_bytes``; for CSV whose records are lines): its ranges stay apart
  as the part files of a folder with the file's name, which Spark reads as the same
  table. A range holds the records that begin in it, so parts are cut at record
  ends; the header line is put before every later part. Each part has the SHA-256
  of its source bytes, and the digest of the whole is the SHA-256 over the list of
  ranges and their digests (a tree of two levels). No task reads more than one
  range, its last record's tail and the header, and every byte is moved once.
* **whole** (everything else): a task streams one range at a time to a part of its
  own beside the target; a second pass, one task a file, puts the parts together
  under a temporary name, hashes them on the way and moves the file into place.

Bytes stream in fixed-size chunks through Arrow's filesystem layer, so memory per
task is one chunk, whatever the file size, and no byte passes through the driver.

``changed_only`` copies only files that the last manifest does not know with the
same size and time of change, or whose landed files are gone (two anti-joins); the
manifest of such a run still names every file.

A task retried after a lost executor rewrites the same parts and the same
target, and never leaves a half-written file under the final name. Same targets
are overwritten; files of earlier runs that are gone from the raw folder stay,
and the manifest of a run names the files that belong to it. A file where a folder
must be, or a folder where a file must be (a raw file that grew or shrank past
``split_bytes``), is moved aside under a hidden name.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Iterable
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import written_once
from strata.sinks.parquet import write_table
from strata.sources.files import CSV_GLOB, list_files, path_exists, qualified
from strata.sources.stores import open_store, store_settings

CHUNK_BYTES = 8 << 20
PART_BYTES = 256 << 20
LANDING_SCHEMA = "source string, target string, bytes long, sha256 string"
#: Of each landed file: its size and place in the source (``header`` bytes before
#: it are repeated), the SHA-256 of its source bytes and of the whole source.
MANIFEST_SCHEMA = (
    "source string, target string, bytes long, sha256 string, start long, stop long, header long, "
    "whole_sha256 string, length long, modified timestamp"
)

# The copy functions run in Python workers. Ship them by value so workers
# need only pandas and pyarrow, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _stream(fin, fout, size: int, chunk: int, digest=None) -> int:
    done = 0
    while done < size and (block := fin.read(min(chunk, size - done))):
        if digest is not None:
            digest.update(block)
        fout.write(block)
        done += len(block)
    return done


def _folder(fs, path: str) -> None:
    """The folder of ``path``; a file in its place is moved aside."""
    folder = path.rsplit("/", 1)[0]
    if fs.get_file_info(folder).type.name == "File":
        _aside(fs, folder, "File")
    fs.create_dir(folder, recursive=True)


def _aside(fs, path: str, kind: str) -> None:
    """Give what lies at ``path`` a hidden name; another task may do the same."""
    parent, name = path.rsplit("/", 1)
    try:
        fs.move(path, f"{parent}/.stale-{uuid.uuid4().hex[:12]}-{name}")
    except OSError:
        if fs.get_file_info(path).type.name == kind:
            raise


def _record_start(fin, at: int, length: int, chunk: int) -> int:
    """The first place from ``at`` on where a line begins."""
    if at <= 0 or at >= length:
        return max(0, min(at, length))
    fin.seek(at - 1)
    at -= 1
    while block := fin.read(min(chunk, length - at)):
        found = block.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(block)
    return length


def _cutter(chunk: int, settings: dict):
    """Lands the records that begin in each range as a part file."""

    def cut_all(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                src_fs, src = open_store(r.source, settings)
                dst_fs, dst = open_store(r.target, settings)
                with src_fs.open_input_file(src) as fin:
                    begin = _record_start(fin, r.start, r.length, chunk)
                    end = _record_start(fin, r.stop, r.length, chunk)
                    if begin >= end:
                        continue  # inside one long record: an earlier part has it
                    header = _record_start(fin, 1, r.length, chunk) if begin and r.header else 0
                    _folder(dst_fs, dst)
                    tmp = f"{dst.rsplit('/', 1)[0]}/.landing-{uuid.uuid4().hex}"
                    digest = hashlib.sha256()
                    with dst_fs.open_output_stream(tmp) as fout:
                        fin.seek(0)
                        _stream(fin, fout, header, chunk)
                        fin.seek(begin)
                        n = _stream(fin, fout, end - begin, chunk, digest)
                if n != end - begin:
                    raise OSError(f"{r.source} ended early: {n} bytes from {begin}")
                dst_fs.move(tmp, dst)
                row = (r.source, r.target, header + n, digest.hexdigest(), begin, end, header)
                yield pd.DataFrame([row], columns=["source", "target", "bytes", "sha256", "start", "stop", "header"])

    return cut_all


def _digester(chunk: int, settings: dict):
    """Hashes landed files again, without the repeated header."""

    def digest_all(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                fs, path = open_store(r.target, settings)
                digest = hashlib.sha256()
                with fs.open_input_file(path) as fin:
                    size = fin.size()
                    fin.seek(r.header)
                    while block := fin.read(chunk):
                        digest.update(block)
                out.append((r.target, size, digest.hexdigest()))
            yield pd.DataFrame(out, columns=["target", "found_bytes", "found_sha256"])

    return digest_all


def landed_differences(spark: SparkSession, manifest: DataFrame, *, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The manifest's rows whose landed file, read again, does not hold the source
    bytes that were hashed when it was copied, with ``found_bytes`` and
    ``found_sha256``. A task reads one landed file (a range) at a time."""
    tasks = 4 * max(spark.sparkContext.defaultParallelism, 2)
    found = (
        manifest.select("target", "header").repartition(tasks, "target")
        .mapInPandas(_digester(chunk_bytes, store_settings(spark)), "target string, found_bytes long, found_sha256 string")
    )
    same = F.col("sha256").eqNullSafe(F.col("found_sha256")) & F.col("bytes").eqNullSafe(F.col("found_bytes"))
    return manifest.join(found, "target", "left").where(~same)


def _part(target: str, run: str, start: int) -> str:
    folder, name = target.rsplit("/", 1)
    return f"{folder}/.landing-{run}/{name}.{start}"


def _range_copier(run: str, chunk: int, settings: dict):
    """Copies the byte ranges of large files to parts of their own."""

    def copy_all(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                src_fs, src = open_store(r.source, settings)
                dst_fs, dst = open_store(_part(r.target, run, r.start), settings)
                _folder(dst_fs, dst)
                with src_fs.open_input_file(src) as fin, dst_fs.open_output_stream(dst) as fout:
                    fin.seek(r.start)
                    n = _stream(fin, fout, r.stop - r.start, chunk)
                if n != r.stop - r.start:
                    raise OSError(f"{r.source} ended early: {n} bytes from {r.start}")
                yield pd.DataFrame([(r.source, r.target, r.start)], columns=["source", "target", "start"])

    return copy_all


def _file_maker(run: str, part_bytes: int, chunk: int, settings: dict):
    """Puts each file together (from its parts if it has several ranges)."""

    def make_all(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                src_fs, src = open_store(r.source, settings)
                dst_fs, dst = open_store(r.target, settings)
                _folder(dst_fs, dst)
                folder = dst.rsplit("/", 1)[0]
                tmp = f"{folder}/.landing-{uuid.uuid4().hex}"
                digest, size = hashlib.sha256(), 0
                parts = r.length > part_bytes
                with dst_fs.open_output_stream(tmp) as fout:
                    for start in range(0, max(r.length, 1), part_bytes):
                        if parts:
                            src_fs, src = open_store(_part(r.target, run, start), settings)
                        with src_fs.open_input_stream(src) as fin:
                            size += _stream(fin, fout, sys.maxsize if not parts else part_bytes, chunk, digest)
                        if not parts:
                            break
                if dst_fs.get_file_info(dst).type.name == "Directory":
                    _aside(dst_fs, dst, "Directory")
                dst_fs.move(tmp, dst)
                out.append((r.source, r.target, size, digest.hexdigest()))
            yield pd.DataFrame(out, columns=["source", "target", "bytes", "sha256"])

    return make_all


def _part_remover(run: str, settings: dict):
    def remove(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                fs, path = open_store(f"{r.folder}/.landing-{run}", settings)
                if fs.get_file_info(path).type.name == "Directory":  # else a retried task's work
                    fs.delete_dir(path)
            yield pdf

    return remove


def set_aside(spark: SparkSession, bronze_q: str, manifest: DataFrame, entries: Iterable[str]) -> None:
    """Give files below ``entries`` that the manifest does not name a hidden name
    (``.stale-<name>`` beside them), in tasks; readers of the folder then see the
    manifest's files only."""
    settings, under = store_settings(spark), [e + "/" for e in entries]
    listed = list_files(spark, bronze_q, "*").join(manifest, F.col("path") == F.col("target"), "left_anti")
    entry = F.concat(F.lit(bronze_q + "/"), F.split(F.substring("path", len(bronze_q) + 2, 1 << 30), "/").getItem(0), F.lit("/"))
    stale = written_once(listed.where(entry.isin(under)).select("path"), "stale")
    if stale.isEmpty():
        return

    def move(batches):
        for pdf in batches:
            for path in pdf["path"]:
                fs, at = open_store(path, settings)
                if fs.get_file_info(at).type.name == "File":  # else a retried task's work
                    parent, name = at.rsplit("/", 1)
                    fs.move(at, f"{parent}/.stale-{name}")
            yield pdf

    stale.mapInPandas(move, "path string").write.format("noop").mode("overwrite").save()


def _ranges(files: DataFrame, size: int) -> DataFrame:
    """Every file with each ``start`` and ``stop`` of its ranges."""
    step = F.lit(size).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, step)
    return files.withColumn("start", F.explode(starts)).withColumn("stop", F.least(F.col("start") + step, F.col("length")))


def _copy_whole(spark, files: DataFrame, out: str, part_bytes: int, chunk_bytes: int) -> DataFrame:
    """Land each file as one file; ``LANDING_SCHEMA``, written at ``out``."""
    settings, run = store_settings(spark), uuid.uuid4().hex[:12]
    tasks = max(spark.sparkContext.defaultParallelism, 2)
    large = files.where(F.col("length") > part_bytes)
    some = not large.isEmpty()
    if some:
        write_table(
            _ranges(large, part_bytes).repartition(tasks * 4, "target", "start")
            .mapInPandas(_range_copier(run, chunk_bytes, settings), "source string, target string, start long"),
            f"{out}-parts",
        )
    made = files.repartition(tasks, "target").mapInPandas(_file_maker(run, part_bytes, chunk_bytes, settings), LANDING_SCHEMA)
    copied = written_once(made, "landed")
    if some:
        folders = large.select(F.regexp_replace("target", "/[^/]*$", "").alias("folder")).distinct()
        folders.mapInPandas(_part_remover(run, settings), "folder string").write.format("noop").mode("overwrite").save()
    return copied


def _cut(spark, files: DataFrame, split_bytes: int, chunk_bytes: int, header: bool) -> DataFrame:
    """Land each file as a folder of its ranges; manifest rows, written once."""
    tasks = 4 * max(spark.sparkContext.defaultParallelism, 2)
    ranges = _ranges(files, split_bytes).withColumn("header", F.lit(header)).withColumn(
        "target", F.concat("target", F.lit("/part-"), F.lpad(F.col("start").cast("string"), 20, "0"), F.lit(".csv"))
    )
    parts = written_once(
        ranges.repartition(tasks, "target").mapInPandas(
            _cutter(chunk_bytes, store_settings(spark)),
            "source string, target string, bytes long, sha256 string, start long, stop long, header long",
        ),
        "landed-ranges",
    )
    leaf = F.concat_ws(" ", "start", "stop", "sha256")
    listed = F.array_sort(F.collect_list(F.struct("start", leaf.alias("leaf"))))["leaf"]
    whole = parts.groupBy("source").agg(
        F.sha2(F.array_join(listed, "\n"), 256).alias("whole_sha256"), F.sum(F.col("stop") - F.col("start")).alias("covered")
    )
    return parts.join(whole, "source")


def _unchanged(spark, files: DataFrame, bronze_q: str, last: str, cut: Column) -> DataFrame:
    """The last manifest's rows of sources with the same size and time of change
    whose landed files are all in place and are cut as they would be now."""
    known = spark.read.schema(MANIFEST_SCHEMA).parquet(last)
    present = list_files(spark, bronze_q, "*").select(F.col("path").alias("target"), F.col("length").alias("found"))
    gone = known.join(present, "target", "left").where(~F.col("bytes").eqNullSafe(F.col("found"))).select("source").distinct()
    now = files.select("source", "length", "modified")
    as_now = known.where(cut == (F.element_at(F.split("target", "/"), -2) == F.element_at(F.split("source", "/"), -1)))
    return as_now.join(now, ["source", "length", "modified"], "left_semi").join(gone, "source", "left_anti")


def land_files(
    spark: SparkSession,
    raw_root: str,
    bronze_root: str,
    *,
    glob: str = CSV_GLOB,
    chunk_bytes: int = CHUNK_BYTES,
    part_bytes: int = PART_BYTES,
    manifest_path: str | None = None,
    split_bytes: int | None = None,
    uncut: Column | None = None,
    header: bool = True,
    changed_only: bool = False,
) -> DataFrame:
    """Copy every file matching ``glob`` under ``raw_root`` to the same
    relative path under ``bronze_root``.

    Files over ``split_bytes`` are cut into ranges (``None``: none is), but for those
    that ``uncut``, a condition on ``source``, holds for. The result
    (``MANIFEST_SCHEMA``, one row a landed file) is written as a Parquet table
    (default ``<bronze_root>/_landing``, hidden from table discovery) and returned
    from there, so the copy runs exactly once.
    """
    raw_q, bronze_q = qualified(spark, raw_root), qualified(spark, bronze_root)
    out = manifest_path or f"{bronze_q}/_landing"
    files = written_once(
        list_files(spark, raw_q, glob).select(
            F.col("path").alias("source"),
            F.concat(F.lit(bronze_q), F.substring("path", len(raw_q) + 1, 1 << 30)).alias("target"),
            "length",
            F.col("modificationTime").alias("modified"),
        ),
        "raw-files",
    )
    cut = F.lit(False)
    if split_bytes is not None:
        cut = (F.col("length") > split_bytes) & ~F.coalesce(uncut if uncut is not None else F.lit(False), F.lit(False))
    parts, todo = [], files
    if changed_only and path_exists(spark, f"{out}/_SUCCESS"):
        kept = written_once(_unchanged(spark, files, bronze_q, out, cut), "unchanged")
        todo = written_once(files.join(kept.select("source").distinct(), "source", "left_anti"), "changed")
        parts.append(kept)
    about = todo.select("source", "length", "modified")
    large = todo.where(cut)
    if split_bytes is not None and not large.isEmpty():
        landed = _cut(spark, large, split_bytes, chunk_bytes, header).join(about, "source")
        short = landed.where("covered != length").select("source").first()
        if short:
            raise OSError(f"{short['source']} changed while it was landed")
        parts.append(landed)
    whole = _copy_whole(spark, todo.where(~cut), out, part_bytes, chunk_bytes).join(about, "source")
    zero = F.lit(0).cast("long")
    parts.append(whole.withColumns({"start": zero, "stop": F.col("bytes"), "header": zero, "whole_sha256": F.col("sha256")}))
    columns = [f.split()[0] for f in MANIFEST_SCHEMA.split(", ")]
    manifest = reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])
    write_table(manifest, out)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(out)
