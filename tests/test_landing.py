"""Landing in ranges, of changed files only, and the listing by levels."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from strata.config import Config
from strata.plans.pipeline import Layers, bronze_step, run_pipeline
from strata.sinks.landing import land_files, landed_differences
from strata.sources.files import list_files

HEADER = b"id,name\n"


def _lines(n, width=0):
    return [b"%d,%s\n" % (i, b"x" * (width or i % 37)) for i in range(n)]


def _landed_bytes(manifest, source):
    parts = sorted((r for r in manifest if r.source.endswith("/" + source)), key=lambda r: r.start)
    out = b""
    for r in parts:
        data = open(r.target.removeprefix("file:"), "rb").read()
        assert len(data) == r.bytes and r.bytes - r.header == r.stop - r.start and r.start == len(out)
        assert r.header == 0 or data[: r.header] == HEADER
        assert hashlib.sha256(data[r.header :]).hexdigest() == r.sha256
        out += data[r.header :]
    return out, parts


@pytest.mark.parametrize("chunk", [3, 100, 1 << 20])
def test_large_csv_is_landed_in_ranges(spark, tmp_path, chunk):
    raw, bronze = tmp_path / "raw", tmp_path / "bronze"
    raw.mkdir()
    files = {
        "lines.csv": HEADER + b"".join(_lines(300)),
        "long.csv": HEADER + b"1," + b"y" * 5000 + b"\n2,b\n",  # a record longer than several ranges
        "no_end.csv": HEADER + b"".join(_lines(100)) + b"100,last",
        "crlf.csv": HEADER + b"".join(_lines(200)).replace(b"\n", b"\r\n"),
        "small.csv": HEADER + b"1,a\n",
        "even.csv": (HEADER + b"1,abcde\n" * 124)[:1000],
        "empty.csv": b"",
    }
    for name, data in files.items():
        (raw / name).write_bytes(data)
    manifest = land_files(spark, str(raw), str(bronze), split_bytes=500, chunk_bytes=chunk)
    rows = manifest.collect()
    for name, data in files.items():
        got, parts = _landed_bytes(rows, name)
        assert got == data, name
        assert (len(parts) > 1) == (len(data) > 500), name
        # no part goes beyond its range but for the tail of its last record
        assert all(r.stop - r.start <= 500 + 5010 for r in parts)
        leaves = "\n".join(f"{r.start} {r.stop} {r.sha256}" for r in parts)
        whole = hashlib.sha256(leaves.encode() if len(data) > 500 else data).hexdigest()
        assert {r.whole_sha256 for r in parts} == {whole}
        df = spark.read.option("header", True).option("recursiveFileLookup", True).csv(f"{bronze}/{name}")
        want = spark.read.option("header", True).csv(f"{raw}/{name}")
        assert sorted(map(str, df.collect())) == sorted(map(str, want.collect()))
    assert landed_differences(spark, manifest).isEmpty()
    part = next(r for r in rows if r.source.endswith("lines.csv") and r.start > 0)
    path = part.target.removeprefix("file:")
    data = bytearray(open(path, "rb").read())
    data[-2] ^= 1
    open(path, "wb").write(data)
    os.remove(f"{os.path.dirname(path)}/.{os.path.basename(path)}.crc") if os.path.exists(f"{os.path.dirname(path)}/.{os.path.basename(path)}.crc") else None
    assert [r.target for r in landed_differences(spark, manifest).collect()] == [part.target]


def test_files_that_grow_and_shrink_past_a_range(spark, tmp_path):
    raw, bronze = tmp_path / "raw", tmp_path / "bronze"
    raw.mkdir()
    for n in (3, 300, 2, 400):
        data = HEADER + b"".join(_lines(n))
        (raw / "t.csv").write_bytes(data)
        rows = land_files(spark, str(raw), str(bronze), split_bytes=500).collect()
        assert _landed_bytes(rows, "t.csv")[0] == data
        df = spark.read.option("header", True).option("recursiveFileLookup", True).csv(f"{bronze}/t.csv")
        assert df.count() == n


def test_tables_whose_lines_are_no_records_stay_whole(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    quoted = b"id,name\n" + b"".join(b'%d,"two\nlines"\n' % i for i in range(200))
    for name in ("quoted", "plain"):
        (raw / f"{name}.csv").write_bytes(quoted if name == "quoted" else HEADER + b"".join(_lines(200)))
    config = Config.from_dict({"tables": {"quoted": {"options": {"multiLine": True}}}})
    layers = Layers.under(str(tmp_path / "lake"))
    sources = bronze_step(spark, str(raw), layers, config, split_bytes=300)
    assert os.path.isfile(f"{layers.bronze}/quoted.csv") and os.path.isdir(f"{layers.bronze}/plain.csv")
    assert set(sources) == {"quoted", "plain"}
    audit = {r.table: r.rows for r in run_pipeline(spark, str(raw), layers, config, gold=False, split_bytes=300).collect()}
    assert audit == {"quoted": 200, "plain": 200}
    assert spark.read.parquet(f"{layers.silver}/quoted").where("name = 'two\nlines'").count() == 200


def test_only_changed_files_are_copied(spark, tmp_path):
    raw, bronze = tmp_path / "raw", tmp_path / "bronze"
    raw.mkdir()
    for name, n in (("a", 300), ("b", 3), ("c", 4), ("d", 5)):
        (raw / f"{name}.csv").write_bytes(HEADER + b"".join(_lines(n)))
    land = lambda **k: land_files(spark, str(raw), str(bronze), split_bytes=500, **k).collect()
    key = lambda rows: sorted((r.source, r.target, r.bytes, r.sha256, r.whole_sha256) for r in rows)
    first = land(changed_only=True)
    assert key(land()) == key(first)
    (raw / "b.csv").write_bytes(HEADER + b"9,new\n")
    (bronze / "c.csv").unlink()  # lost from the lake
    (raw / "d.csv").unlink()
    (raw / "e.csv").write_bytes(HEADER)
    times = {p: p.stat().st_mtime_ns for p in bronze.rglob("*.csv") if p.is_file()}
    again = land(changed_only=True)
    assert {r.source.rsplit("/", 1)[1] for r in again} == {"a.csv", "b.csv", "c.csv", "e.csv"}
    for name in ("a.csv", "b.csv", "c.csv", "e.csv"):
        assert _landed_bytes(again, name)[0] == (raw / name).read_bytes()
    kept = {p for p, t in times.items() if p.exists() and p.stat().st_mtime_ns == t}
    assert {p.parent.name for p in kept if p.parent.name == "a.csv"} == {"a.csv"}  # not written again
    assert bronze / "b.csv" not in kept
    assert key(again) == key(land())


def test_the_listing_goes_by_levels(spark, tmp_path):
    root = tmp_path / "raw"
    wanted = set()
    for i in range(2000):
        folder = root / "big.csv" / f"d{i % 40}" / f"e{i}"
        folder.mkdir(parents=True)
        if i % 4 == 0:
            (folder / "x.csv").write_text("a\n")
            wanted.add(f"big.csv/d{i % 40}/e{i}/x.csv")
    (root / "top.CSV").write_text("a\n")
    (root / "big.csv" / "_hidden").mkdir()
    (root / "big.csv" / "_hidden" / "y.csv").write_text("a\n")
    (root / "big.csv" / ".z.csv").write_text("a\n")
    (root / "big.csv" / "notes.txt").write_text("a\n")
    found = list_files(spark, f"file:{root}")
    got = {r.path.split("/raw/")[1]: r.length for r in found.collect()}
    assert set(got) == wanted | {"top.CSV"} and set(got.values()) == {2}
    # the level of 2,000 folders was listed by several tasks
    last = found.select(F.input_file_name().alias("f")).where("f like '%part-%'").distinct().count()
    assert last > 1
    assert set(r.path.split("/raw/")[1] for r in list_files(spark, f"file:{root}", "*.txt").collect()) == {"big.csv/notes.txt"}
