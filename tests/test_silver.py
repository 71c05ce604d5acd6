"""CSV reading cases, schema declarations and the silver cleaning steps."""

import pytest
from pyspark.sql.types import IntegerType, StringType

from conftest import rows
from strata.config import Config, Defaults, TableSpec, to_struct_type
from strata.operators.silver import (
    cast_timestamps,
    clean,
    drop_exact_duplicates,
    require_key,
    resolve_key,
)
from strata.sources.csv import DECLARED, INFERRED, read_declared, read_table

CASES_CSV = '''id,n,s,t
1,NULL,NULL,2012-03-19 08:04:16
2,,,not a date
3,abc,"",2012-3-19 8:4:16
4,7,"NULL",2012-03-19 08:04:16
'''

SPEC = TableSpec.from_dict(
    {"primary_key": "id", "columns": {"id": "int", "n": "int", "s": "string", "t": "string"}}
)


def test_struct_type():
    st = to_struct_type({"a": "int", "b": "string"})
    assert [(f.name, f.dataType, f.nullable) for f in st.fields] == [
        ("a", IntegerType(), True), ("b", StringType(), True)
    ]
    with pytest.raises(KeyError, match="decimal"):
        to_struct_type({"a": "decimal"})


def test_csv_null_and_bad_cells(spark, tmp_path):
    p = tmp_path / "cases.csv"
    p.write_text(CASES_CSV)
    df = read_declared(spark, str(p), SPEC)
    got = rows(df)
    assert got[0][:3] == (1, None, None)          # NULL sentinel
    assert got[1][:3] == (2, None, None)          # empty unquoted -> NULL
    assert got[2][:3] == (3, None, "")            # bad int -> NULL, "" stays empty
    assert got[3][:3] == (4, 7, None)             # quoted "NULL" -> NULL
    ts = rows(cast_timestamps(df, ["t"]), "t")
    assert ts[1] == (None,) and ts[2] == (None,)  # unparsable -> NULL, no error
    assert ts[0][0] is not None and ts[3][0] is not None


def test_declared_header_must_match(spark, tmp_path):
    p = tmp_path / "swapped.csv"
    p.write_text("n,id,s,t\n1,2,x,y\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_declared(spark, str(p), SPEC).collect()


def test_enforce_schema_option_wins(spark, tmp_path):
    from strata.config import Config
    from strata.sources.csv import read_table

    path = tmp_path / "t.csv"
    path.write_text("other,names\n1,x\n")
    cfg = Config.from_dict({"tables": {"t": {"columns": {"id": "int", "v": "string"}, "options": {"enforceSchema": "true"}}}})
    df, _ = read_table(spark, str(path), cfg.spec("t"), cfg.defaults)
    assert [tuple(r) for r in df.collect()] == [(1, "x")]


def test_declare_or_infer(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text("day,spend,channel\n2012-03-19 00:00:00,1.5,a\n2012-03-20 00:00:00,2,b\n")
    df, origin = read_table(spark, str(p))
    assert origin == INFERRED
    assert dict(df.dtypes) == {"day": "timestamp", "spend": "double", "channel": "string"}
    _, origin = read_table(spark, str(p), TableSpec.from_dict(
        {"columns": {"day": "string", "spend": "double", "channel": "string"}}))
    assert origin == DECLARED


def test_cast_only_text_columns(spark):
    df = spark.createDataFrame([("2012-03-19 08:04:16", 1)], "created_at string, x int")
    out = cast_timestamps(df, ["created_at", "x", "missing"])
    assert dict(out.dtypes) == {"created_at": "timestamp", "x": "int"}
    assert cast_timestamps(out, ["created_at"]) is out


def test_dedup_and_key(spark):
    df = spark.createDataFrame(
        [(1, None), (1, None), (None, "a"), (2, "b"), (2, "c")], "k int, v string"
    )
    d = drop_exact_duplicates(df)
    assert d.count() == 4
    assert drop_exact_duplicates(d).count() == 4  # idempotent
    assert resolve_key(df) == "k"
    assert resolve_key(df, TableSpec(primary_key="v")) == "v"
    assert require_key(df, "k").count() == 4
    assert require_key(df, "K").count() == 5  # not a column: no filter
    cleaned, key = clean(df)
    assert key == "k" and cleaned.count() == 3  # same key, different values: both stay


def test_config_roundtrip(tmp_path):
    import json

    from conftest import GOLDEN_CONFIG

    p = tmp_path / "tables.json"
    p.write_text(json.dumps(GOLDEN_CONFIG))
    cfg = Config.load(str(p))
    assert cfg.defaults == Defaults()
    assert cfg.spec("orders").primary_key == "order_id"
    assert not cfg.spec("unknown").declared


def test_csv_options_from_config(spark, tmp_path):
    p = tmp_path / "notes.csv"
    p.write_text('id,note\n1,"two\nlines"\n2,one\n')
    plain, _ = read_table(spark, str(p))
    assert plain.count() == 3  # Spark's default: a quoted newline splits the record
    cfg = Config.from_dict({"tables": {"notes": {"options": {"multiLine": "true"}}}})
    multi, _ = read_table(spark, str(p), cfg.spec("notes"))
    assert rows(multi) == [(1, "two\nlines"), (2, "one")]
    cfg2 = Config.from_dict({"defaults": {"csv_options": {"multiLine": "true"}}})
    assert read_table(spark, str(p), defaults=cfg2.defaults)[0].count() == 2


def test_defaults_switches(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("id,v\n1,N/A\n1,N/A\n2,x\n")
    keep = Defaults(drop_duplicates=False, null_value="N/A")
    df, _ = read_table(spark, str(p), defaults=keep)
    cleaned, key = clean(df, defaults=keep)
    assert key == "id" and cleaned.count() == 3          # duplicates kept
    assert rows(cleaned.where("id = 1"), "v") == [(None,), (None,)]  # custom sentinel
    cleaned2, _ = clean(df, defaults=Defaults(null_value="N/A"))
    assert cleaned2.count() == 2
