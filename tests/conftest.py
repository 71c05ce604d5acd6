import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from strata.session import local_session

    s = local_session(4, shuffle_partitions=4)
    # Tests run in local mode with no shared folder configured: use our own.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-test-ckpt-"))
    yield s
    s.stop()


SESSIONS_CSV = """website_session_id,created_at,utm_source,utm_campaign,http_referer,device_type
1,2012-03-19 08:04:16,gsearch,nonbrand,https://www.gsearch.com,mobile
1,2012-03-19 08:04:16,gsearch,nonbrand,https://www.gsearch.com,mobile
2,2012-03-20 08:04:16,NULL,NULL,https://www.bsearch.com,desktop
3,2012-03-21 08:04:16,NULL,NULL,NULL,desktop
4,2012-04-01 00:00:00,gsearch,NULL,https://www.gsearch.com,desktop
5,2012-04-02 00:00:00,newsrc,xx,foo,desktop
6,2012-04-02 00:00:00,NULL,NULL,foo,desktop
NULL,2012-04-02 00:00:00,NULL,NULL,foo,desktop
7,2012-05-02 00:00:00,NULL,NULL,NULL,desktop
"""

ORDERS_CSV = """order_id,created_at,website_session_id,price_usd
1,2012-03-19 09:00:00,1,49.99
2,2012-03-31 23:59:00,2,20.01
3,2012-04-01 00:30:00,4,30
4,2012-06-01 00:00:00,3,10
5,2012-04-01 00:30:00,999,5
"""

# Table names, keys and columns of the reference's two tables.
GOLDEN_CONFIG = {
    "tables": {
        "website_sessions": {
            "primary_key": "website_session_id",
            "columns": {
                "website_session_id": "int",
                "created_at": "string",
                "utm_source": "string",
                "utm_campaign": "string",
                "http_referer": "string",
                "device_type": "string",
            },
        },
        "orders": {
            "primary_key": "order_id",
            "columns": {
                "order_id": "int",
                "created_at": "string",
                "website_session_id": "int",
                "price_usd": "double",
            },
        },
    },
}


@pytest.fixture()
def raw_dir(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "website_sessions.csv").write_text(SESSIONS_CSV)
    (raw / "orders.csv").write_text(ORDERS_CSV)
    return str(raw)


@pytest.fixture()
def golden(spark, raw_dir):
    """Silver sessions and orders of the golden fixture."""
    from strata.config import Config
    from strata.operators.silver import clean
    from strata.sources.csv import read_table

    cfg = Config.from_dict(GOLDEN_CONFIG)
    out = {}
    for name in ("website_sessions", "orders"):
        df, _ = read_table(spark, f"{raw_dir}/{name}.csv", cfg.spec(name), cfg.defaults)
        out[name] = clean(df, cfg.spec(name), cfg.defaults)[0]
    return out["website_sessions"], out["orders"]


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
