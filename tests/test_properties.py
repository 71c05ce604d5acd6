"""Property tests: channel expressions against a plain Python model of the
rules, on random values (one Spark job per generated batch)."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.functions import channels as ch

PIECES = ["gsearch", "bsearch", "socialbook", "nonbrand", "brand", "pilot", "www.", "http://",
          "https://", "/", ".", "a", "B", " ", "é", ":8080", "@"]
value = st.one_of(
    st.none(),
    st.just(""),
    st.lists(st.sampled_from(PIECES), max_size=6).map("".join),
    st.text(max_size=8),
)


def model(source, campaign, referer):
    def lab(v, m):
        return None if v is None else m.get(v, v)

    if source is not None:
        kind = "Payant"
        s, c = lab(source, ch.SOURCE_LABELS), lab(campaign, ch.CAMPAIGN_LABELS)
        label = None if c is None else f"{s}{ch.PAID_SEPARATOR}{c}"
    elif referer is not None:
        kind = "Naturel"
        m = re.search(ch.REFERER_HOST_PATTERN, referer)
        host = m.group(1) if m else ""
        label = f"{lab(host, ch.SOURCE_LABELS)}{ch.ORGANIC_SUFFIX}"
    else:
        kind, label = "Direct", ch.DIRECT_LABEL
    return kind, label


@settings(max_examples=15, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(value, value, value), min_size=1, max_size=40))
def test_channel_rules_match_model(spark, triples):
    df = spark.createDataFrame(triples, "s string, c string, r string")
    got = df.select(
        ch.acquisition_type("s", "r"), ch.channel_label("s", "c", "r")
    ).collect()
    assert [tuple(r) for r in got] == [model(*t) for t in triples]


visit = st.tuples(
    st.integers(0, 6),                                   # visit id (duplicates likely)
    st.sampled_from([None, "gsearch", "a", "x"]),        # source
    st.sampled_from([None, "brand", "naturel", "y"]),    # campaign
    st.sampled_from([None, "", "https://www.bsearch.com", "https://a Ads/x", "junk"]),
)
conversion = st.tuples(st.one_of(st.none(), st.integers(0, 8)),
                       st.integers(0, 10_000).map(lambda c: c / 100))


@settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(visit, min_size=1, max_size=25), st.lists(conversion, max_size=40))
def test_one_pass_channel_table_equals_composition(spark, visits, conversions):
    from strata.operators.channels import (
        channel_orders,
        channel_performance,
        channel_sessions,
        join_channel_totals,
        label_visits,
    )

    v = spark.createDataFrame(
        visits, "website_session_id long, utm_source string, utm_campaign string, "
        "http_referer string")
    c = spark.createDataFrame(conversions, "website_session_id long, price_usd double")
    labeled = label_visits(v)
    parts = join_channel_totals(channel_sessions(labeled), channel_orders(labeled, c))
    fused = channel_performance(v, c)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, fused.collect()), key=key) == sorted(map(tuple, parts.collect()), key=key)


def _round_half_up(x, digits=2):
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


day = st.one_of(st.none(), st.dates(min_value=__import__("datetime").date(2023, 11, 1),
                                     max_value=__import__("datetime").date(2024, 2, 28)))


@settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(day, min_size=1, max_size=30),
       st.lists(st.tuples(day, st.integers(0, 99_999)), max_size=30))
def test_period_trend_matches_model(spark, visit_days, conv):
    from collections import Counter
    from decimal import Decimal

    from strata.operators.trend import period_trend

    v = spark.createDataFrame([(d,) for d in visit_days], "d date").selectExpr(
        "cast(d as timestamp_ntz) as created_at")
    c = spark.createDataFrame([(d, cents / 100) for d, cents in conv], "d date, price_usd double") \
        .selectExpr("cast(d as timestamp_ntz) as created_at", "price_usd")
    month = lambda d: None if d is None else d.strftime("%Y-%m")
    sessions = Counter(month(d) for d in visit_days)
    orders = Counter(month(d) for d, _ in conv)
    revenue = {}
    for d, cents in conv:
        revenue[month(d)] = revenue.get(month(d), Decimal(0)) + Decimal(cents) / 100
    want = []
    for m, n in sessions.items():
        # NULL never matches in the join: its conversions are not counted
        o = orders.get(m, 0) if m is not None else 0
        r = float(revenue.get(m, Decimal(0))) if m is not None else 0.0
        want.append((m, n, o, r, _round_half_up(o / n * 100), _round_half_up(r / o) if o else None))
    got = [tuple(row) for row in period_trend(v, c).collect()]
    key = lambda t: (t[0] is not None, t[0] or "")
    assert sorted(got, key=key) == sorted(want, key=key)


channel_row = st.tuples(
    st.sampled_from(["A", "B", "C", "D", None]),
    st.sampled_from(["Payant", "Naturel", "Direct", "Autre"]),
    st.integers(1, 300),                       # sessions
    st.integers(0, 900),                       # orders
    st.integers(0, 500_000).map(lambda c: c / 100),  # revenue
)


@settings(max_examples=12, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(channel_row, min_size=1, max_size=12))
def test_channel_figures_match_model(spark, table):
    from decimal import Decimal

    from strata.operators import insights as ins

    rows = [(ch, t, s, o, r, _round_half_up(o / s * 100), _round_half_up(r / s))
            for ch, t, s, o, r in table]
    df = spark.createDataFrame(rows, "channel string, channel_type string, sessions long, "
                               "orders long, revenue double, conversion_rate_pct double, "
                               "revenue_per_session_usd double")
    # type mix: the three types in order, absent ones dropped
    kept = [t for t in ("Payant", "Naturel", "Direct") if any(r[1] == t for r in rows)]
    total = sum(Decimal(str(r[4])) for r in rows if r[1] in kept)
    want_mix = []
    for t in kept:
        sel = [r for r in rows if r[1] == t]
        rev = float(sum(Decimal(str(r[4])) for r in sel))
        s, o = sum(r[2] for r in sel), sum(r[3] for r in sel)
        share = rev / float(total) * 100 if total else None
        want_mix.append((t, s, o, rev, share, o / s * 100))
    got_mix = [tuple(r) for r in ins.channel_type_mix(df).collect()]
    assert got_mix == want_mix
    paid = next((m[4] for m in want_mix if m[0] == "Payant"), None)
    got_share = ins.paid_free_share(df).first()
    assert got_share.paid_share_pct == (paid if paid is not None else 0.0)
    # top channel: most revenue, ties by channel (NULL last) then type
    order = sorted(rows, key=lambda r: (-r[4], r[0] is None, r[0] or "", r[1]))
    assert tuple(ins.top_channel(df).first())[:2] == order[0][:2]
    # best / worst converting among channels with >= 100 sessions
    sig = [r for r in rows if r[2] >= 100]
    bw = ins.best_worst_channel(df).first()
    if not sig:
        assert bw.best_channel is None and bw.worst_channel is None
    else:
        by_conv = sorted(sig, key=lambda r: (-r[5], r[0] is None, r[0] or "", r[1]))
        assert (bw.best_channel, bw.best_conversion_pct) == (by_conv[0][0], by_conv[0][5])
        assert (bw.worst_channel, bw.worst_conversion_pct) == (by_conv[-1][0], by_conv[-1][5])


month_row = st.tuples(
    st.one_of(st.none(), st.integers(0, 23).map(lambda i: f"{2020 + i // 12}-{i % 12 + 1:02d}")),
    st.integers(1, 500),                      # sessions
    st.integers(0, 50),                       # orders
)


@settings(max_examples=12, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(month_row, min_size=1, max_size=10, unique_by=lambda r: r[0]))
def test_period_figures_match_model(spark, months):
    from statistics import fmean

    from strata.operators import insights as ins

    rows = []
    for ym, s, o in months:
        rev = o * 12.5
        rows.append((ym, s, o, rev, _round_half_up(o / s * 100),
                     _round_half_up(rev / o) if o else None))
    df = spark.createDataFrame(rows, "year_month string, sessions long, orders long, "
                               "revenue double, conversion_rate_pct double, aov_usd double")
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or ""))  # NULL month last
    first, last = ordered[:3], ordered[-3:]

    def mean(rs, i):
        vals = [r[i] for r in rs if r[i] is not None]
        return fmean(vals) if vals else None

    w = ins.trend_windows(df).first()
    assert w.sessions_first == pytest.approx(mean(first, 1))
    assert w.sessions_last == pytest.approx(mean(last, 1))
    assert w.aov_first == pytest.approx(mean(first, 5)) if mean(first, 5) is not None \
        else w.aov_first is None
    best = max(ordered, key=lambda r: r[2])  # first of the most orders, in month order
    assert ins.best_period(df).first().year_month == best[0]
    k = ins.kpi_totals(df).first()
    assert (k.total_sessions, k.total_orders) == (sum(r[1] for r in rows), sum(r[2] for r in rows))


csv_row = st.tuples(
    st.one_of(st.just("NULL"), st.integers(0, 4).map(str)),                 # key
    st.sampled_from(["2012-03-19 08:04:16", "2012-04-01 00:00:00", "not a date", "NULL"]),
    st.sampled_from(["a", "b", "NULL"]),
)


@settings(max_examples=10, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(csv_row, min_size=1, max_size=20))
def test_silver_clean_matches_model(spark, tmp_path_factory, raw_rows):
    import datetime

    from strata.config import TableSpec
    from strata.operators.silver import clean
    from strata.sources.csv import read_table

    path = tmp_path_factory.mktemp("silver") / "t.csv"
    path.write_text("id,created_at,v\n" + "".join(f"{a},{b},{c}\n" for a, b, c in raw_rows))
    spec = TableSpec.from_dict({"primary_key": "id",
                                "columns": {"id": "int", "created_at": "string", "v": "string"}})
    from pyspark.sql import functions as F

    df, _ = read_table(spark, str(path), spec)
    cleaned = clean(df, spec)[0].select(
        "id", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"), "v")
    got = sorted((tuple(r) for r in cleaned.collect()), key=str)

    def parse(t):  # the text a parsed timestamp formats back to, or NULL
        if t in ("NULL", "not a date"):
            return None
        return datetime.datetime.strptime(t, "%Y-%m-%d %H:%M:%S").strftime("%Y-%m-%d %H:%M:%S")

    model = {(int(a), parse(b), None if c == "NULL" else c) for a, b, c in raw_rows if a != "NULL"}
    assert got == sorted(model, key=str)


@settings(max_examples=6, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.binary(max_size=3000), min_size=1, max_size=4), st.integers(1, 700))
def test_landing_is_byte_exact_for_any_content(spark, tmp_path_factory, contents, chunk):
    import hashlib
    import os

    from strata.sinks.landing import land_files

    root = tmp_path_factory.mktemp("land")
    raw, bronze = root / "raw", root / "bronze"
    (raw / "t.csv").mkdir(parents=True)
    for i, data in enumerate(contents):
        (raw / "t.csv" / f"part-{i}.csv").write_bytes(data)
    landed = land_files(spark, str(raw), str(bronze), chunk_bytes=chunk).collect()
    assert len(landed) == len(contents)
    for r in landed:
        name = os.path.basename(r.target)
        data = (raw / "t.csv" / name).read_bytes()
        assert (bronze / "t.csv" / name).read_bytes() == data
        assert r.bytes == len(data) and r.sha256 == hashlib.sha256(data).hexdigest()
