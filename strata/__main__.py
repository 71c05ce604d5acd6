"""Run the five-step pipeline from the command line.

    spark-submit --py-files strata.zip strata/__main__.py \\
        --raw s3a://raw/shop --lake s3a://lake/shop --config tables.json

(or ``python -m strata ...`` with PySpark installed). The session comes from
``SparkSession.builder.getOrCreate()``, so master, resources and
``spark.checkpoint.dir`` are whatever the submit command configures. The
audit is printed at the end; a failing step stops the run with an error.
"""

from __future__ import annotations

import argparse
import logging
import os


def main(argv=None) -> None:
    """Parse the arguments, run the pipeline, print the audit."""
    parser = argparse.ArgumentParser(prog="strata", description=__doc__.split("\n")[0])
    parser.add_argument("--raw", required=True, help="folder of raw CSV tables")
    parser.add_argument("--lake", required=True, help="root of the bronze/silver/gold/report layers")
    parser.add_argument("--config", help="tables.json with defaults and table declarations")
    parser.add_argument("--visits", default="website_sessions")
    parser.add_argument("--conversions", default="orders")
    parser.add_argument("--jdbc-url", default=os.environ.get("STRATA_JDBC_URL"))
    parser.add_argument("--jdbc-user", default=os.environ.get("STRATA_JDBC_USER"))
    parser.add_argument("--jdbc-password", default=os.environ.get("STRATA_JDBC_PASSWORD"))
    parser.add_argument("--jdbc-driver", default=os.environ.get("STRATA_JDBC_DRIVER"))
    parser.add_argument("--jdbc-connections", type=int, default=8,
                        help="database connections per table load")
    parser.add_argument("--workers", type=int, default=4, help="tables written at once")
    parser.add_argument("--register", action="store_true",
                        help="register the layers in the session's catalog (silver.<t>, gold.<t>,"
                             " report.<t>); lasting only with a persistent metastore")
    parser.add_argument("--move-registered", action="store_true",
                        help="registered names may follow a lake that was moved")
    parser.add_argument("--spark-conf", action="append", default=[], metavar="KEY=VALUE",
                        help="extra Spark setting for the session (repeatable)")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")

    from pyspark.sql import SparkSession

    from strata.config import Config
    from strata.plans.pipeline import Layers, run_pipeline

    builder = SparkSession.builder.appName("strata")
    for item in args.spark_conf:
        key, _, value = item.partition("=")
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    config = Config.load(args.config) if args.config else Config()
    props = {
        k: v
        for k, v in (
            ("user", args.jdbc_user),
            ("password", args.jdbc_password),
            ("driver", args.jdbc_driver),
        )
        if v
    }
    audit = run_pipeline(
        spark,
        args.raw,
        Layers.under(args.lake),
        config,
        visits=args.visits,
        conversions=args.conversions,
        jdbc_url=args.jdbc_url,
        jdbc_properties=props,
        jdbc_connections=args.jdbc_connections,
        workers=args.workers,
        register=args.register,
        move_registered=args.move_registered,
    )
    audit.show(200, truncate=False)


if __name__ == "__main__":
    main()
