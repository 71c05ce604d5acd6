"""Session helpers: a local session for tests and benchmarks, and the
shared scratch folder taken from ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on, for sessions this module builds itself.
# On a cluster these belong in the job's configuration.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A local[cores] session with the library's settings (tests, benchmarks)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("strata")
    settings = dict(LOCAL_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cores)
    settings.setdefault("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
    # The catalog's default database folder; a cluster configures its own.
    settings.setdefault("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="strata-warehouse-"))
    settings.update(conf)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a fresh folder of
    its own (as in tests); a cluster session must name a shared one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder every executor can reach"
        )
    path = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/strata-{label}-{uuid.uuid4().hex[:12]}"


def written_once(df, label: str):
    """``df`` written under the shared folder and read back: what is built on
    it several times is computed once, and no executor's loss takes it away."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
