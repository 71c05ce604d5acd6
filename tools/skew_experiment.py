"""Skew experiment: attribution when one visit holds a third of all
conversions.

Visits are the B1 visits of ``orders``; conversions are ``lineitem``
repeated ``copies`` times (``explode(sequence(...))``), with every third row
re-keyed to one order. The library's plan (conversions reduced per visit
before the join) is timed against joining raw conversions and aggregating
afterwards.

    python tools/skew_experiment.py [sf_dir] [copies] [--no-broadcast]

``--no-broadcast`` turns broadcast joins off (planner and AQE), which is the
plan a cluster gets when neither side fits under the broadcast threshold:
the naive plan then shuffles every raw conversion and sends the hot visit's
third of them to one reducer.
"""

from __future__ import annotations

import statistics
import sys
import time

sys.path.insert(0, ".")
sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.abspath(__file__)))


def main() -> None:
    from pyspark.sql import functions as F

    from strata.functions.ratios import money_sum
    from strata.operators import channels as chan
    from strata.plans import bindings as b
    from strata.session import local_session

    import glob
    import os
    import tempfile

    from profile_stages import _stages

    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    no_broadcast = "--no-broadcast" in sys.argv
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    copies = int(args[1]) if len(args) > 1 else 50
    log_dir = tempfile.mkdtemp(prefix="strata-eventlog-")
    spark = local_session(8, shuffle_partitions=64, **{
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    if no_broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    visits = b.b1_visits(spark, sf_dir)
    hot = visits.agg(F.min("website_session_id")).first()[0]
    li = b.table(spark, sf_dir, "lineitem")
    conv = (
        li.select("l_orderkey", "l_linenumber", "l_extendedprice",
                  F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"))
        .select(
            F.when((F.col("l_linenumber") + F.col("copy")) % 3 == 0, F.lit(hot))
            .otherwise(F.col("l_orderkey")).alias("website_session_id"),
            F.col("l_extendedprice").alias("price_usd"),
        )
    )
    labeled = chan.label_visits(visits).select("website_session_id", "channel", "channel_type")
    naive = (
        labeled.join(conv, "website_session_id", "left")
        .groupBy("channel", "channel_type")
        .agg(F.count(F.lit(1)).alias("n"), F.count("price_usd").alias("orders"),
             money_sum("price_usd").alias("revenue"))
    )
    plans = {"pre-aggregated (library)": lambda: chan.channel_performance(visits, conv),
             "join raw, then aggregate": lambda: naive}

    def run(make, group):
        spark.sparkContext.setJobGroup(group, group)
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run(plans["pre-aggregated (library)"], "warm-up")
    times = {k: [] for k in plans}
    for i in range(3):
        for k, make in plans.items():
            times[k].append(run(make, f"{k}#{i}"))
    spark.sparkContext.setJobGroup("count", "count")
    n = conv.count()
    spark.stop()
    stages = _stages(glob.glob(os.path.join(log_dir, "*"))[0])
    print(f"conversions={n:,} hot visit={hot} share=~1/3 copies={copies} "
          f"broadcast={'off' if no_broadcast else 'on'}")
    for k, ts in times.items():
        st = stages.get(f"{k}#0", [])
        written = sum(s["shuffle_write"] for s in st)
        slowest = max((s["ms"] for s in st), default=0)
        print(f"{k:28s} median {statistics.median(ts):.2f}s  runs {[round(t, 2) for t in ts]}  "
              f"shuffle written {written / 1e6:.1f} MB  slowest stage {slowest} ms")


if __name__ == "__main__":
    main()
