"""JDBC sink paths that need no database (none is started in tests)."""

import pytest

from strata.sinks.jdbc import load_layer, write_jdbc


def test_empty_layer_loads_nothing(spark, tmp_path):
    assert load_layer(spark, str(tmp_path / "none"), "silver", "jdbc:unused:x") == []


def test_unknown_driver_fails_clearly(spark):
    df = spark.range(3)
    with pytest.raises(Exception, match="(?i)driver"):
        write_jdbc(df, "jdbc:nosuchdb://nowhere/db", "silver.t", {}, num_partitions=2)


def test_pipeline_reaches_the_jdbc_writer(spark, raw_dir, tmp_path):
    from conftest import GOLDEN_CONFIG
    from strata.config import Config
    from strata.plans.pipeline import Layers, run_pipeline

    with pytest.raises(Exception, match="(?i)driver"):
        run_pipeline(spark, raw_dir, Layers.under(str(tmp_path / "lake")),
                     Config.from_dict(GOLDEN_CONFIG), jdbc_url="jdbc:nosuchdb://nowhere/db")
