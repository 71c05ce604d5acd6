"""Sources, sinks and the five-step pipeline on the golden raw folder."""

import hashlib
import os

import pytest

from conftest import GOLDEN_CONFIG, rows
from strata.config import Config
from strata.plans.pipeline import Layers, run_pipeline
from strata.sinks.landing import land_files
from strata.sinks.parquet import write_table
from strata.sources.files import csv_manifest, lake_tables
from strata.sources.lake import warehouse_sql
from test_golden import CHANNELS, MONTHLY


def test_manifest(spark, raw_dir, tmp_path):
    (tmp_path / "raw" / "notes.txt").write_text("x")
    (tmp_path / "raw" / "upper.CSV").write_text("a\n1\n")
    m = rows(csv_manifest(spark, raw_dir), "table", "files")
    assert m == [("orders", 1), ("upper", 1), ("website_sessions", 1)]
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "x.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        csv_manifest(spark, str(empty))


def test_landing_is_byte_exact(spark, raw_dir, tmp_path):
    bronze = str(tmp_path / "bronze")
    landed = land_files(spark, raw_dir, bronze).collect()
    assert len(landed) == 2
    for r in landed:
        src = open(os.path.join(raw_dir, os.path.basename(r.source)), "rb").read()
        dst = open(os.path.join(bronze, os.path.basename(r.target)), "rb").read()
        assert src == dst and r.sha256 == hashlib.sha256(src).hexdigest()
        assert r.bytes == len(src)
    # files far larger than one chunk stream through in pieces
    big = land_files(spark, raw_dir, str(tmp_path / "b2"), chunk_bytes=7).collect()
    for r in big:
        src = open(os.path.join(raw_dir, os.path.basename(r.source)), "rb").read()
        dst = open(os.path.join(str(tmp_path / "b2"), os.path.basename(r.target)), "rb").read()
        assert src == dst and r.sha256 == hashlib.sha256(src).hexdigest()
    assert not [n for n in os.listdir(str(tmp_path / "b2")) if n.startswith(".landing-")]


def test_write_table_counts(spark, tmp_path):
    df = spark.range(1234).repartition(5)
    assert write_table(df, str(tmp_path / "t")) == 1234
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1234
    assert lake_tables(spark, str(tmp_path)) == ["t"]
    assert lake_tables(spark, str(tmp_path / "missing")) == []


def test_pipeline_golden(spark, raw_dir, tmp_path):
    layers = Layers.under(str(tmp_path / "lake"))
    audit = run_pipeline(spark, raw_dir, layers, Config.from_dict(GOLDEN_CONFIG))
    got = {(r.layer, r.table): (r.rows, r.origin, r.key) for r in audit.collect()}
    assert got[("silver", "website_sessions")] == (7, "declare", "website_session_id")
    assert got[("silver", "orders")] == (5, "declare", "order_id")
    assert got[("gold", "gold_monthly_trend")][0] == 3
    assert got[("gold", "gold_channel_performance")][0] == 6
    conv = {r.table: r.conversions for r in audit.collect() if r.layer == "gold"}
    # 5 silver orders: June has no visit (monthly drops 1); order 3 has a
    # NULL channel and order 5 no visit (channels drop 2)
    assert conv == {"gold_monthly_trend": 4, "gold_channel_performance": 3}
    assert got[("report", "insight_summary")][0] == 1
    monthly = spark.read.parquet(f"{layers.gold}/gold_monthly_trend")
    assert sorted(rows(monthly), key=str) == sorted(MONTHLY, key=str)
    channels = spark.read.parquet(f"{layers.gold}/gold_channel_performance")
    assert sorted(rows(channels), key=str) == sorted(CHANNELS, key=str)
    # the report's SQL over the gold tables, through Catalyst
    top = warehouse_sql(
        spark,
        "SELECT channel FROM {gold_channel_performance} ORDER BY revenue DESC LIMIT 1",
        {"gold_channel_performance": channels},
    ).first()[0]
    assert top == "Google Ads · acquisition"
    # a re-run gives the same tables
    run_pipeline(spark, raw_dir, layers, Config.from_dict(GOLDEN_CONFIG))
    again = spark.read.parquet(f"{layers.gold}/gold_monthly_trend")
    assert sorted(rows(again), key=str) == sorted(MONTHLY, key=str)


def test_pipeline_rejects_duplicate_stems(spark, raw_dir, tmp_path):
    (tmp_path / "raw" / "orders.CSV").write_text("a\n1\n")
    with pytest.raises(ValueError, match="two raw entries"):
        run_pipeline(spark, raw_dir, Layers.under(str(tmp_path / "lake")))


def test_audit_counts_unparsed_and_stale(spark, raw_dir, tmp_path):
    from conftest import ORDERS_CSV, SESSIONS_CSV

    extra = tmp_path / "raw2"
    extra.mkdir()
    (extra / "website_sessions.csv").write_text(SESSIONS_CSV)
    (extra / "orders.csv").write_text(ORDERS_CSV)
    (extra / "spend.csv").write_text(
        "id,created_at,amount\n1,2012-03-19 08:04:16,1.5\n2,not a date,2\n3,,3\n4,2012-3-1 1:2:3,4\n"
    )
    layers = Layers.under(str(tmp_path / "lake"))
    cfg = Config.from_dict(GOLDEN_CONFIG)
    first = {r.table: r for r in run_pipeline(spark, str(extra), layers, cfg).collect()}
    assert first["spend"].origin == "infere" and first["spend"].unparsed == 2
    assert first["website_sessions"].unparsed == 0
    second = {r.table: r for r in run_pipeline(spark, raw_dir, layers, cfg).collect()}
    assert second["spend"].origin == "stale" and second["spend"].rows is None


def test_landing_again_is_idempotent(spark, raw_dir, tmp_path):
    bronze = str(tmp_path / "bronze")
    first = sorted((r.target, r.sha256) for r in land_files(spark, raw_dir, bronze).collect())
    again = sorted((r.target, r.sha256) for r in land_files(spark, raw_dir, bronze).collect())
    assert first == again
    names = os.listdir(bronze)
    assert sorted(n for n in names if not n.startswith("_")) == ["orders.csv", "website_sessions.csv"]
    assert not [n for n in names if n.startswith(".landing-")]


def test_command_line(spark, raw_dir, tmp_path, capsys):
    import json

    from strata.__main__ import main

    cfg = tmp_path / "tables.json"
    cfg.write_text(json.dumps(GOLDEN_CONFIG))
    main(["--raw", raw_dir, "--lake", str(tmp_path / "lake"), "--config", str(cfg)])
    out = capsys.readouterr().out
    assert "gold_channel_performance" in out and "website_sessions" in out


def test_folder_of_parts_is_one_table(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "big.csv").mkdir(parents=True)
    (raw / "big.csv" / "part-0.csv").write_text("id,v\n1,a\n2,b\n")
    (raw / "big.csv" / "part-1.csv").write_text("id,v\n3,c\n")
    (raw / "big.csv" / "_SUCCESS").write_text("")
    (raw / "small.csv").write_text("id,v\n9,z\n")
    m = rows(csv_manifest(spark, str(raw)), "table", "files")
    assert m == [("big", 2), ("small", 1)]
    layers = Layers.under(str(tmp_path / "lake"))
    audit = {r.table: r.rows for r in run_pipeline(spark, str(raw), layers, gold=False).collect()}
    assert audit == {"big": 3, "small": 1}
    # rewritten with fewer rows and other part names: nothing of the first run is left
    for p in (raw / "big.csv").iterdir():
        p.unlink()
    (raw / "big.csv" / "part-7.csv").write_text("id,v\n1,new\n")
    run_pipeline(spark, str(raw), layers, gold=False)
    assert rows(spark.read.parquet(f"{layers.silver}/big"), "id", "v") == [(1, "new")]
    # a CSV in a folder that is no table is refused, not dropped
    (raw / "notes").mkdir()
    (raw / "notes" / "x.csv").write_text("id\n1\n")
    assert rows(csv_manifest(spark, str(raw)), "table", "files") == [("big", 1), ("small", 1)]
    with pytest.raises(ValueError, match="notes/x.csv"):
        run_pipeline(spark, str(raw), layers, gold=False)


def test_a_missing_gold_input_stops_the_run(spark, raw_dir, tmp_path):
    layers = Layers.under(str(tmp_path / "lake"))
    cfg = Config.from_dict(GOLDEN_CONFIG)
    run_pipeline(spark, raw_dir, layers, cfg)
    (tmp_path / "raw" / "orders.csv").unlink()
    with pytest.raises(FileNotFoundError, match="orders"):  # the first run's silver is not taken
        run_pipeline(spark, raw_dir, layers, cfg)


def test_a_large_file_is_copied_in_ranges(spark, tmp_path):
    import hashlib

    raw = tmp_path / "raw"
    raw.mkdir()
    data = os.urandom(1_000_003)
    (raw / "big.csv").write_bytes(data)
    (raw / "even.csv").write_bytes(data[:300_000])
    (raw / "small.csv").write_bytes(b"x")
    bronze = tmp_path / "bronze"
    landed = land_files(spark, str(raw), str(bronze), part_bytes=100_000, chunk_bytes=7_000)
    got = {os.path.basename(r.target): (r.bytes, r.sha256) for r in landed.collect()}
    assert got["big.csv"] == (len(data), hashlib.sha256(data).hexdigest())
    assert (bronze / "big.csv").read_bytes() == data
    assert (bronze / "even.csv").read_bytes() == data[:300_000] and (bronze / "small.csv").read_bytes() == b"x"
    parts = spark.read.parquet(str(bronze / "_landing-parts"))
    assert parts.groupBy("target").count().orderBy("count").toPandas()["count"].tolist() == [3, 11]
    assert sorted(n for n in os.listdir(bronze) if not n.startswith("_")) == ["big.csv", "even.csv", "small.csv"]


def test_s3a_settings_reach_arrow(spark):
    from strata.sources.stores import s3_arguments

    assert s3_arguments({}) == {}
    assert s3_arguments({"endpoint": "http://store:9000", "access.key": "a", "secret.key": "b", "path.style.access": "true"}) == {
        "endpoint_override": "store:9000", "scheme": "http", "force_virtual_addressing": False,
        "access_key": "a", "secret_key": "b"}
    assert s3_arguments({"endpoint": "store", "connection.ssl.enabled": "false", "endpoint.region": "r"}) == {
        "endpoint_override": "store", "scheme": "http", "force_virtual_addressing": True, "region": "r"}


def test_catalog_leaves_other_tables_alone(spark, tmp_path):
    from strata.sources.lake import register_layer

    layer = tmp_path / "layer"
    spark.range(3).write.parquet(f"{layer}/t")
    spark.sql("CREATE DATABASE IF NOT EXISTS keepdb")
    spark.sql("DROP TABLE IF EXISTS keepdb.t")
    spark.range(5).write.saveAsTable("keepdb.t")
    with pytest.raises(ValueError, match="another table"):
        register_layer(spark, str(layer), "keepdb")
    assert spark.table("keepdb.t").count() == 5
    spark.sql("DROP TABLE keepdb.t")
    assert register_layer(spark, str(layer), "keepdb") == ["t"]
    assert register_layer(spark, str(layer), "keepdb") == ["t"]
    assert spark.table("keepdb.t").count() == 3
    spark.sql("DROP TABLE keepdb.t")


def test_registered_names_follow_a_moved_layer(spark, tmp_path):
    from strata.sources.lake import register_layer

    for n, name in ((3, "a"), (4, "b")):
        spark.range(n).write.parquet(f"{tmp_path}/{name}/t")
    register_layer(spark, f"{tmp_path}/a", "movedb")
    with pytest.raises(ValueError, match="another table"):
        register_layer(spark, f"{tmp_path}/b", "movedb")
    assert spark.table("movedb.t").count() == 3
    register_layer(spark, f"{tmp_path}/b", "movedb", move=True)
    assert spark.table("movedb.t").count() == 4
    spark.sql("DROP DATABASE movedb CASCADE")
    assert spark.read.parquet(f"{tmp_path}/b/t").count() == 4  # only names went


def test_catalog_query_runs_again_and_in_a_second_session(spark):
    from strata.plans.catalog import warehouse_catalog_sql

    sf = "/root/testdata/sf0.001"
    before = {d.name for d in spark.catalog.listDatabases()}
    first = warehouse_catalog_sql(spark, sf)
    again = warehouse_catalog_sql(spark, sf)
    other = warehouse_catalog_sql(spark.newSession(), sf)
    assert first.collect() == again.collect() == other.collect()
    assert {d.name for d in spark.catalog.listDatabases()} == before


def test_sql_views_do_not_outlive_the_statement(spark):
    from strata.sources.lake import warehouse_sql

    spark.range(2).createOrReplaceTempView("mine")
    assert warehouse_sql(spark, "SELECT count(*) AS n FROM {mine}", {"mine": spark.range(7)}).first().n == 7
    assert spark.table("mine").count() == 2
    spark.catalog.dropTempView("mine")


def test_layers_registered_in_the_catalog(spark, raw_dir, tmp_path):
    layers = Layers.under(str(tmp_path / "lake"))
    audit = run_pipeline(spark, raw_dir, layers, Config.from_dict(GOLDEN_CONFIG), register=True)
    registered = {r.table for r in audit.collect() if r.layer == "catalog"}
    assert {"silver.website_sessions", "gold.gold_monthly_trend", "report.channel_table"} <= registered
    # the ad-hoc queries of the original warehouse, as written
    by_device = spark.sql(
        "SELECT device_type, count(*) AS sessions FROM silver.website_sessions "
        "GROUP BY device_type ORDER BY sessions DESC").collect()
    assert [tuple(r) for r in by_device] == [("desktop", 6), ("mobile", 1)]
    top = spark.sql("SELECT * FROM gold.gold_channel_performance ORDER BY revenue DESC").first()
    assert top.channel == "Google Ads · acquisition"


def test_report_tables_keep_their_order(spark, tmp_path):
    from pyspark.sql import functions as F

    from strata.operators.insights import channel_revenue_series

    raw = tmp_path / "raw"
    raw.mkdir()
    # many channels, so the sort spans several partitions
    lines = ["website_session_id,created_at,utm_source,utm_campaign,http_referer,device_type"]
    lines += [f"{i},2012-03-01 00:00:00,src{i % 37},c{i % 11},NULL,desktop" for i in range(2000)]
    (raw / "website_sessions.csv").write_text("\n".join(lines) + "\n")
    orders = ["order_id,created_at,website_session_id,price_usd"]
    orders += [f"{i},2012-03-02 00:00:00,{i},{(i * 7) % 500}.25" for i in range(2000)]
    (raw / "orders.csv").write_text("\n".join(orders) + "\n")
    layers = Layers.under(str(tmp_path / "lake"))
    run_pipeline(spark, str(raw), layers, Config.from_dict(GOLDEN_CONFIG))
    stored = spark.read.parquet(f"{layers.report}/channel_revenue_series").orderBy("position")
    gold = spark.read.parquet(f"{layers.gold}/gold_channel_performance")
    want = [(r.channel, r.revenue) for r in channel_revenue_series(gold).collect()]
    assert [(r.channel, r.revenue) for r in stored.collect()] == want
    assert stored.agg(F.countDistinct("position")).first()[0] == len(want)


def test_empty_raw_files(spark, raw_dir, tmp_path):
    import os

    (tmp_path / "raw" / "nothing.csv").write_bytes(b"")
    layers = Layers.under(str(tmp_path / "lake"))
    audit = {r.table: r for r in run_pipeline(spark, raw_dir, layers,
                                              Config.from_dict(GOLDEN_CONFIG)).collect()}
    assert audit["nothing"].rows == 0 and audit["nothing"].key is None
    assert os.path.getsize(os.path.join(layers.bronze, "nothing.csv")) == 0  # landed as is
    assert audit["website_sessions"].rows == 7


def test_odd_file_names(spark, tmp_path):
    import os

    raw = tmp_path / "raw"
    raw.mkdir()
    names = ["my table.csv", "a+b.csv", "pct%41.csv", "void.csv"]
    for i, n in enumerate(names):
        (raw / n).write_text("" if n == "void.csv" else f"x\n{i}\n")
    m = rows(csv_manifest(spark, str(raw)), "table", "bytes")
    assert m == [("a+b", 4), ("my table", 4), ("pct%41", 4), ("void", 0)]
    landed = land_files(spark, str(raw), str(tmp_path / "bronze")).collect()
    assert sorted(os.path.basename(r.target) for r in landed) == sorted(names)
    for r in landed:
        name = os.path.basename(r.target)
        assert (tmp_path / "bronze" / name).read_bytes() == (raw / name).read_bytes()
    audit = {r.table: r.rows for r in
             run_pipeline(spark, str(raw), Layers.under(str(tmp_path / "lake")), gold=False).collect()}
    assert audit == {"my table": 1, "a+b": 1, "pct%41": 1, "void": 0}
