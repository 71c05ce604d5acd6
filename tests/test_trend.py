"""Period trend edge cases: NULL times, named periods and free formats."""

from pyspark.sql import functions as F

from conftest import rows
from strata.operators.trend import conversions_per_period, period_trend, visits_per_period


def frames(spark):
    v = spark.createDataFrame(
        [(1, "2024-01-05 10:00:00"), (2, None), (3, "2024-02-01 00:00:00"), (4, None)],
        "website_session_id long, created_at string",
    ).withColumn("created_at", F.to_timestamp("created_at"))
    c = spark.createDataFrame(
        [(1, "2024-01-31 23:59:59", 10.0), (2, None, 5.0), (9, "2024-03-01 00:00:00", 1.0)],
        "website_session_id long, created_at string, price_usd double",
    ).withColumn("created_at", F.to_timestamp("created_at"))
    return v, c


def test_null_period_is_a_group_that_never_matches(spark):
    v, c = frames(spark)
    got = rows(period_trend(v, c))
    # NULL first (ascending), its conversions are not joined; March has no visit
    assert got == [
        (None, 2, 0, 0.0, 0.0, None),
        ("2024-01", 1, 1, 10.0, 100.0, 10.0),
        ("2024-02", 1, 0, 0.0, 0.0, None),
    ]


def test_named_and_free_periods_agree(spark):
    v, c = frames(spark)
    named = rows(visits_per_period(v, period="day", out="p"))
    free = rows(visits_per_period(v, period="yyyy-MM-dd", out="p"))
    assert sorted(named, key=str) == sorted(free, key=str)
    years = rows(conversions_per_period(c, period="year", out="y"))
    assert sorted(years, key=str) == sorted([("2024", 2, 11.0), (None, 1, 5.0)], key=str)


def test_ntz_timestamps(spark):
    v = spark.createDataFrame([(1,)], "website_session_id long").withColumn(
        "created_at", F.lit("2024-05-31 23:30:00").cast("timestamp_ntz"))
    c = v.withColumn("price_usd", F.lit(2.5))
    assert rows(period_trend(v, c), "year_month", "orders") == [("2024-05", 1)]


def test_hour_format_groups_on_text_across_dst(spark):
    from strata.operators.trend import visits_per_period

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 05:30 and 06:30 UTC are both 01:30 local on 2024-11-03 (clocks go back)
        v = spark.createDataFrame([("2024-11-03T05:30:00Z",), ("2024-11-03T06:30:00Z",)], "t string") \
            .select(F.to_timestamp("t").alias("created_at"))
        got = rows(visits_per_period(v, period="yyyy-MM-dd HH", out="h"))
        assert got == [("2024-11-03 01", 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
