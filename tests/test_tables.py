"""Content digests, dense positions, wide duplicates, bad cells, period states."""

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import rows
from strata.config import Config, TableSpec
from strata.operators.period_state import PeriodStore
from strata.operators.positions import with_positions
from strata.operators.silver import drop_exact_duplicates, drop_wide_duplicates
from strata.operators.trend import period_trend
from strata.plans.pipeline import Layers, run_pipeline
from strata.sinks.parquet import ContentMismatch, content_digest, verify_content, write_observed, write_verified
from strata.sources.csv import read_declared

MIXED = [
    (1, "a", 1.5, {"k": 1}, [1, None], Row(x=1, y=None)),
    (1, "a", 1.5, {"k": 1}, [1, None], Row(x=1, y=None)),
    (None, "a", float("nan"), None, [], None),
    (2, None, -0.0, {"a": None, "b": 2}, None, Row(x=None, y=1)),
]
SCHEMA = "id long, name string, v double, m map<string,int>, l array<int>, s struct<x:int,y:int>"


def _mixed(spark, data=MIXED):
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def test_content_is_verified_after_the_write(spark, tmp_path):
    path = str(tmp_path / "t")
    written = write_verified(_mixed(spark), path)
    assert written["rows"] == written["content_rows"] == 4
    verify_content(spark, path, written, _mixed(spark).schema)


@pytest.mark.parametrize("change", [
    lambda d: [*d[:3], (2, "", *d[3][2:])],  # one cell, null to empty
    lambda d: [*d[:2], (None, "b", *d[2][2:]), d[3]],
    lambda d: d[1:],  # a repeated row lost
    lambda d: [*d, d[0]],
    lambda d: [d[2], *d[2:], d[0]],  # a row in place of another
    lambda d: [*d[:3], (*d[3][:3], {"a": 2, "b": None}, *d[3][4:])],  # a null moved inside a map
    lambda d: [*d[:3], (*d[3][:5], Row(x=1, y=None))],  # a null moved inside a struct
])
def test_any_changed_cell_or_row_is_seen(spark, tmp_path, change):
    path = str(tmp_path / "t")
    written = write_observed(_mixed(spark), path, **content_digest(_mixed(spark).schema))
    write_observed(_mixed(spark, change(MIXED)), path)
    with pytest.raises(ContentMismatch):
        verify_content(spark, path, written, _mixed(spark).schema)


def test_the_pipeline_verifies_silver(spark, raw_dir, tmp_path, monkeypatch):
    import strata.sinks.parquet as sink

    from conftest import GOLDEN_CONFIG

    layers = Layers.under(str(tmp_path / "lake"))
    run_pipeline(spark, raw_dir, layers, Config.from_dict(GOLDEN_CONFIG), verify=True, gold=False)
    real = sink.write_observed

    def spoiled(df, path, **k):
        out = real(df, path, **k)
        if path.endswith("silver/orders"):
            kept = [r.asDict() for r in spark.read.parquet(path).collect()]
            kept[0]["price_usd"] += 0.01
            spark.createDataFrame(kept, spark.read.parquet(path).schema).write.mode("overwrite").parquet(path)
        return out

    monkeypatch.setattr(sink, "write_observed", spoiled)
    with pytest.raises(ContentMismatch, match="orders"):
        run_pipeline(spark, raw_dir, layers, Config.from_dict(GOLDEN_CONFIG), verify=True, gold=False)


def test_positions_are_dense(spark):
    df = spark.range(10_000).select((F.col("id") * 7919 % 1000).alias("k"), "id").repartition(7)
    out = with_positions(df, F.desc("k"), "id")
    assert out.columns == ["k", "id", "position"]
    got = sorted(rows(out, "position", "k", "id"))
    want = sorted(((r.k, r.id) for r in df.collect()), key=lambda r: (-r[0], r[1]))
    assert got == [(i + 1, *r) for i, r in enumerate(want)]
    assert with_positions(df.where("false"), "k").collect() == []
    one = with_positions(spark.range(5).orderBy(F.desc("id")))
    assert sorted(rows(one, "position", "id")) == [(i + 1, 4 - i) for i in range(5)]


def test_wide_duplicates(spark):
    base = spark.range(500).select(
        F.col("id") % 400, *[F.when(F.col("id") % 400 % 5 != 0, F.sha2((F.col("id") % 400 + i).cast("string"), 256)).alias(f"c{i}") for i in range(10)],
        F.when(F.col("id") % 400 % 3 == 0, F.lit(float("nan"))).otherwise(F.lit(0.0)).alias("v"))
    want = sorted(map(str, drop_exact_duplicates(base).collect()))
    assert len(want) == 400
    assert sorted(map(str, drop_wide_duplicates(base).collect())) == want
    assert sorted(map(str, drop_wide_duplicates(base, most=5).collect())) == want  # too many: rows are shuffled
    assert drop_wide_duplicates(base.where("false")).collect() == []
    same = base.limit(1).crossJoin(spark.range(50).select(F.lit(1).alias("one")))
    assert drop_wide_duplicates(same).count() == 1


def test_wide_duplicates_do_not_shuffle_unique_rows(spark, tmp_path):
    spark.range(3000).select(F.greatest("id", F.lit(2)).alias("id"), *[F.sha2((F.greatest("id", F.lit(2)) * 31 + i).cast("string"), 512).alias(f"c{i}") for i in range(8)]).write.parquet(f"{tmp_path}/t")
    wide = spark.read.parquet(f"{tmp_path}/t")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = drop_wide_duplicates(wide)
        assert out.count() == 2998
        nodes = json.loads(out._jdf.queryExecution().executedPlan().toJSON())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    names = [n["class"].rsplit(".", 1)[-1] for n in nodes]
    # one exchange of rows, below it only those with a repeated digest
    assert names.count("ShuffleExchangeExec") == 1 and names.count("BroadcastHashJoinExec") == 2


BAD_CSV = 'id,n,v,name\n1,2,3.5,a\n2,x,4,b\nz,y,w,c\n4,,NULL,d\n5,6\n6,7,8,e,extra\n2,x,4,b\n"7",q,1,"d,e"\n'
BAD_SPEC = TableSpec.from_dict({"primary_key": "id", "columns": {"id": "int", "n": "long", "v": "double", "name": "string"}})


def test_bad_cells_are_counted(spark, tmp_path):
    (tmp_path / "t.csv").write_text(BAD_CSV)
    got = read_declared(spark, f"{tmp_path}/t.csv", BAD_SPEC, bad="bad")
    assert got.columns == ["id", "n", "v", "name", "bad"]
    assert rows(got) == [
        (1, 2, 3.5, "a", 0), (2, None, 4.0, "b", 1), (None, None, None, "c", 3), (4, None, None, "d", 0),
        (5, 6, None, None, 1), (6, 7, 8.0, "e", 1), (2, None, 4.0, "b", 1), (7, None, 1.0, "d,e", 1),
    ]


@pytest.mark.parametrize("drop", [True, False])
def test_the_audit_counts_bad_cells_of_rows_that_go(spark, tmp_path, drop):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "t.csv").write_text(BAD_CSV)
    (raw / "u.csv").write_text("a,b\n1,2\n")
    config = Config.from_dict({"defaults": {"drop_duplicates": drop}, "tables": {"t": {"primary_key": "id", "columns": dict(
        zip(("id", "n", "v", "name"), ("int", "long", "double", "string")))}}})
    layers = Layers.under(str(tmp_path / "lake"))
    audit = {r.table: (r.rows, r.bad_cells) for r in run_pipeline(spark, str(raw), layers, config, gold=False).collect()}
    assert audit == {"t": (6 if drop else 7, 8), "u": (1, 0)}
    assert spark.read.parquet(f"{layers.silver}/t").columns == ["id", "n", "v", "name"]


def test_period_states_merge_to_the_whole(spark, golden, tmp_path):
    visits, conversions = golden
    want = sorted(map(tuple, period_trend(visits, conversions).collect()), key=str)
    store = PeriodStore(spark, f"{tmp_path}/s")
    with pytest.raises(FileNotFoundError):
        store.trend()
    with pytest.raises(ValueError):
        store.put("nothing")
    store.put("v1", visits=visits.where("website_session_id < 4"))
    store.put("v2", visits=visits.where("website_session_id >= 4"), conversions=conversions.where("order_id > 2"))
    store.put("late", conversions=conversions)  # wrong at first
    store.put("late", conversions=conversions.where("order_id <= 2"))
    assert sorted(map(tuple, store.trend().collect()), key=str) == want
    assert [r[0] for r in store.trend().collect()] == [r[0] for r in period_trend(visits, conversions).collect()]
    nan = conversions.withColumn("price_usd", F.lit(float("nan")))
    store.put("late", conversions=nan.where("order_id <= 2"))
    whole = conversions.where("order_id > 2").unionByName(nan.where("order_id <= 2"))
    assert str(sorted(map(tuple, store.trend().collect()), key=str)) == str(
        sorted(map(tuple, period_trend(visits, whole).collect()), key=str))
