"""Report figures on the golden gold tables."""

import pytest

from conftest import rows
from strata.operators import insights as ins
from strata.operators.channels import channel_performance
from strata.operators.trend import period_trend


@pytest.fixture()
def gold(golden):
    sessions, orders = golden
    return period_trend(sessions, orders), channel_performance(sessions, orders)


def test_kpis_and_windows(gold):
    monthly, _ = gold
    k = ins.kpi_totals(monthly).first()
    assert (k.total_sessions, k.total_orders, k.total_revenue) == (7, 4, 105.0)
    assert k.overall_conversion_pct == 57.14
    w = ins.trend_windows(monthly).first()
    # three months only: both windows are all months
    assert w.sessions_first == w.sessions_last == pytest.approx(7 / 3)
    assert w.aov_first == pytest.approx((35.0 + 17.5) / 2)  # NULL AOV skipped
    g = ins.trend_growth(monthly).first()
    assert g.sessions_growth_pct == 0.0 and g.conversion_change == 0.0
    d = ins.trend_direction(monthly).first()
    assert d.sessions_direction == "en hausse" and d.conversion_direction == "en progression"


def test_windows_skip_null_month_first(spark):
    m = spark.createDataFrame(
        [(None, 9, 9, 1.0, 1.0), ("2012-01", 1, 1, 2.0, 2.0), ("2012-02", 2, 2, 3.0, None),
         ("2012-03", 3, 3, 4.0, 4.0), ("2012-04", 4, 4, 5.0, 5.0)],
        "year_month string, sessions long, orders long, conversion_rate_pct double, aov_usd double",
    )
    w = ins.trend_windows(m, 2).first()
    assert w.sessions_first == 1.5  # 2012-01, 2012-02
    assert w.sessions_last == 6.5   # 2012-04 and the NULL month (last)
    assert w.aov_first == 2.0


def test_best_month_tie_goes_to_earliest(gold):
    monthly, _ = gold
    assert rows(ins.best_period(monthly), "year_month", "orders") == [("2012-03", 2)]


def test_channel_figures(gold):
    _, channels = gold
    assert rows(ins.top_channel(channels), "channel")[0][0] == "Google Ads · acquisition"
    assert ins.significant_channels(channels).count() == 0
    bw = ins.best_worst_channel(channels, min_sessions=1).first()
    assert bw.best_channel == "Bing · naturel"  # tie at 100 %: name order
    assert bw.worst_channel is None and bw.worst_conversion_pct == 0.0
    assert bw.best_vs_top_ratio == 1.0
    empty = ins.best_worst_channel(channels).first()
    assert empty.best_channel is None and empty.best_vs_top_ratio is None


def test_type_mix_and_shares(gold):
    _, channels = gold
    mix = rows(ins.channel_type_mix(channels))
    assert [r[0] for r in mix] == ["Payant", "Naturel", "Direct"]
    assert [r[1:4] for r in mix] == [(3, 1, 49.99), (2, 1, 20.01), (2, 1, 10.0)]
    assert [round(r[4], 4) for r in mix] == [62.4875, 25.0125, 12.5]
    s = ins.paid_free_share(channels).first()
    assert s.paid_share_pct == pytest.approx(62.4875) and s.free_share_pct == pytest.approx(37.5125)


def test_type_mix_drops_absent_types(spark):
    ch = spark.createDataFrame(
        [("x", "Direct", 4, 1, 2.5), ("y", "Other", 1, 1, 1.0)],
        "channel string, channel_type string, sessions long, orders long, revenue double",
    )
    mix = rows(ins.channel_type_mix(ch), "channel_type", "share_revenue_pct")
    assert mix == [("Direct", 100.0)]
    assert ins.paid_free_share(ch).first().paid_share_pct == 0.0


def test_tables_and_series(gold):
    _, channels = gold
    t = ins.channel_table(channels)
    assert t.columns == ["Canal", "Type", "Sessions", "Commandes", "Conv. %", "CA ($)",
                         "CA / session ($)"]
    first = t.first()
    assert first["CA ($)"] == "49.99" and first["Conv. %"] == "100.00"
    assert ins.channel_table(channels, max_rows=2).count() == 2
    tt = ins.type_table(channels)
    assert tt.columns == ["Type", "Sessions", "Commandes", "Conv. %", "CA ($)", "Part du CA (%)"]
    series = rows(ins.channel_revenue_series(channels), "revenue")
    assert [r[0] for r in series] == sorted(r[0] for r in series)
    conv = ins.channel_conversion_series(channels, min_sessions=2).first()
    assert conv.conversion_label == "50.00%"


def test_summary_is_one_row(gold):
    monthly, channels = gold
    s = ins.insight_summary(monthly, channels)
    assert s.count() == 1
    r = s.first()
    assert r.best_month == "2012-03" and r.top_channel == "Google Ads · acquisition"
    assert r.total_sessions == 7 and r.paid_share_pct == pytest.approx(62.4875)
