"""Column functions: referrer host, labels, channel type, ratios, text."""

import math

import pytest

from conftest import rows
from strata.functions import channels as ch
from strata.functions import ratios, text

HOSTS = [
    ("https://www.gsearch.com", "gsearch"),
    ("http://m.foo.com/x", "m"),
    ("http://localhost:8080/", "localhost:8080"),
    ("https://www.", "www"),
    ("gsearch.com", ""),
    ("HTTPS://WWW.X.com", ""),
    ("https://u@h.com", "u@h"),
    ("http://10.0.0.1/", "10"),
    ("android-app://https://www.zz.org", "zz"),
    ("", ""),
    (None, None),
]


def test_referer_host(spark):
    df = spark.createDataFrame([(u,) for u, _ in HOSTS], "u string")
    got = rows(df.select("u", ch.referer_host("u").alias("h")))
    assert got == HOSTS


def test_label_of(spark):
    df = spark.createDataFrame([("gsearch",), ("zzz",), (None,), ("",)], "s string")
    got = [r[0] for r in df.select(ch.label_of("s", ch.SOURCE_LABELS)).collect()]
    assert got == ["Google", "zzz", None, ""]
    assert [r[0] for r in df.select(ch.label_of("s", {})).collect()] == ["gsearch", "zzz", None, ""]


def test_acquisition_type(spark):
    df = spark.createDataFrame(
        [("x", None), (None, "r"), (None, None), ("", None), (None, "")], "s string, r string"
    )
    got = [r[0] for r in df.select(ch.acquisition_type("s", "r")).collect()]
    assert got == ["Payant", "Naturel", "Direct", "Payant", "Naturel"]


def test_ratios_never_fail_on_zero(spark):
    df = spark.createDataFrame([(1, 0), (2, 3), (None, 3)], "n long, d long")
    got = rows(df.select(ratios.pct("n", "d").alias("p"), ratios.ratio("n", "d").alias("r")))
    assert got == [(None, None), (66.67, 0.67), (None, None)]


def test_round_half_up_on_decimal_form(spark):
    df = spark.createDataFrame([(0.285,), (0.125,), (1.005,)], "x double")
    assert [r[0] for r in df.select(ratios.ratio("x", ratios.F.lit(1))).collect()] == [
        0.29, 0.13, 1.01
    ]


def test_money_sum_is_exact(spark):
    vals = [(0.1,), (0.2,), (0.3,)] * 1000
    df = spark.createDataFrame(vals, "x double").repartition(7)
    assert df.agg(ratios.money_sum("x")).first()[0] == 600.0


def test_money_sum_rounds_no_amount(spark):
    nan, inf = float("nan"), float("inf")

    def total(*amounts):
        return spark.createDataFrame([(a,) for a in amounts], "x double").agg(ratios.money_sum("x")).first()[0]

    assert total(*[0.004] * 10) == 0.04
    assert total(1.005, -0.005) == 1.0
    assert math.isnan(total(nan, 5.0)) and math.isnan(total(inf, -inf))
    assert total(inf, 5.0) == inf and total(-inf, None) == -inf
    assert total(1e17, 1e300) == 1e300 and total(1e17, 0.5) == 1e17
    assert total(1 / 3, 1 / 3) == 2 / 3 and total(-2.5, 1.25) == -1.25
    assert total(None, None) is None and total() is None


@pytest.mark.parametrize(
    "x,grouped,plain,k",
    [
        (1234.5, "1,234.50", "1234.50", "$1k"),
        (0.125, "0.12", "0.12", "$0k"),
        (1.005, "1.00", "1.00", "$0k"),
        (123456.0, "123,456.00", "123456.00", "$123k"),
        (-1234.5, "-1,234.50", "-1234.50", "$-1k"),
    ],
)
def test_number_text_matches_python_format(spark, x, grouped, plain, k):
    assert grouped == f"{x:,.2f}"
    assert plain == f"{x:.2f}"
    df = spark.createDataFrame([(x,)], "x double")
    r = df.select(text.grouped("x"), text.plain("x"), text.thousands_usd("x")).first()
    assert r[0] == grouped and r[1] == plain
    # Python's f"${v/1000:,.0f}k" puts the sign after the dollar.
    assert r[2] == f"${x/1000:,.0f}k" == k


def test_direction(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (None,), (float("nan"),)], "x double")
    assert [r[0] for r in df.select(text.direction("x")).collect()] == [
        "en hausse", "en hausse", "en baisse", "en baisse", "en baisse"
    ]
