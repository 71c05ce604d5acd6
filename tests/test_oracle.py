"""Every catalog query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from strata.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


#: Queries with an order of their own: the oracle's rows in that order.
_BY_REVENUE = "ORDER BY revenue DESC, channel ASC NULLS LAST, channel_type ASC"
ORDERED = {
    "monthly_trend": "ORDER BY year_month ASC NULLS FIRST",
    "daily_trend": "ORDER BY day ASC NULLS FIRST",
    "trend_series": "ORDER BY year_month ASC NULLS LAST",
    "channel_performance": _BY_REVENUE,
    "channel_performance_fanout": _BY_REVENUE,
    "channel_revenue_series": "ORDER BY revenue ASC, channel DESC NULLS FIRST, channel_type DESC",
    "channel_conversion_series": "ORDER BY conversion_rate_pct ASC, channel DESC NULLS FIRST, channel_type DESC",
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    import pandas as pd

    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "year_month" and df.count() > 0


def test_every_key_has_a_query():
    sql = entry.oracle_sql()
    assert set(sql) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, key):
    got = entry.queries()[key](spark, SF).toPandas()
    sql = entry.oracle_sql().get(key)
    if sql is None:
        assert len(got) > 0
        return
    want = con.execute(sql).df()
    assert _rows(got) == _rows(want)
    if key in ORDERED:
        by = sorted(got.columns)
        assert got[by].map(_norm).values.tolist() == con.execute(f"SELECT * FROM ({sql}) {ORDERED[key]}").df()[by].map(_norm).values.tolist()
