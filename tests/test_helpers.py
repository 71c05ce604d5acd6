"""Session, sink and combination helpers."""

import types

import pytest
from pyspark.sql import functions as F

from strata.operators.insights import side_by_side
from strata.session import checkpoint_dir, scratch_path
from strata.sinks.parquet import write_observed


def _fake_session(master, ckpt=None):
    sc = types.SimpleNamespace(master=master, getCheckpointDir=lambda: ckpt)
    conf = types.SimpleNamespace(get=lambda key, default=None: default)
    return types.SimpleNamespace(sparkContext=sc, conf=conf)


def test_cluster_session_needs_a_shared_checkpoint_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_fake_session("spark://master:7077"))
    assert checkpoint_dir(_fake_session("spark://m:7077", "hdfs://nn/ckpt/x")) == "hdfs://nn/ckpt/x"


def test_scratch_paths_are_fresh(spark):
    a, b = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert a != b and a.startswith(checkpoint_dir(spark).rstrip("/"))


def test_write_observed_metrics(spark, tmp_path):
    df = spark.range(10).withColumn("flag", (F.col("id") % 3 == 0).cast("int"))
    m = write_observed(df, str(tmp_path / "t"), drop=["flag"], flagged=F.sum("flag"))
    assert m == {"rows": 10, "flagged": 4}
    assert spark.read.parquet(str(tmp_path / "t")).columns == ["id"]


def test_side_by_side(spark):
    a = spark.createDataFrame([(1, "x")], "n long, s string")
    b = spark.createDataFrame([], "m double")
    row = side_by_side(a, b).collect()
    assert [tuple(r) for r in row] == [(1, "x", None)]
