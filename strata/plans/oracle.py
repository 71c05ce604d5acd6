"""DuckDB SQL for each catalog key: the independent check of the Spark
queries, run by the driver on the same parquet tables.

The SQL spells out the reference's own shape (separate aggregates and
joins) rather than the Spark plans, so a planning shortcut taken on the
Spark side is checked against the plain definition.

Two engine differences are bridged here and nowhere else:
* rounding: DuckDB's ``round`` on a double works on the binary value, Spark
  rounds the decimal form half-up, so ``R(x)`` rounds via the decimal text;
* money sums: both sum the decimal text of the amounts exactly.
"""

from __future__ import annotations


def R(x: str, digits: int = 2) -> str:
    """Spark's half-up rounding of a double, in DuckDB SQL."""
    return (
        f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)"
    )


def MONEY_SUM(x: str) -> str:
    """Exact sum of an amount, as a double."""
    return f"CAST(sum(CAST(CAST({x} AS VARCHAR) AS DECIMAL(28,12))) AS DOUBLE)"


def pick(key: str, values) -> str:
    """``values[key mod len(values)]`` as a CASE expression."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({key}) % {len(values)} {whens} END"


def _b1_sessions() -> str:
    from strata.plans.bindings import (
        B1_CAMPAIGNS,
        B1_DONE_REFERERS,
        B1_OPEN_REFERER,
        B1_SOURCES,
    )

    return f"""
  sessions AS (
    SELECT o_orderkey AS website_session_id,
           o_orderdate AS created_at,
           CASE WHEN o_orderstatus = 'O' THEN {pick('o_orderkey', B1_SOURCES)} END AS utm_source,
           CASE WHEN o_orderstatus = 'O' THEN {pick('o_orderkey', B1_CAMPAIGNS)} END AS utm_campaign,
           CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN '{B1_OPEN_REFERER}'
                WHEN o_orderstatus = 'F' THEN {pick('o_orderkey', B1_DONE_REFERERS)} END AS http_referer,
           CASE WHEN o_orderkey % 3 = 0 THEN 'mobile' ELSE 'desktop' END AS device_type
    FROM orders)"""


B1_CONV = """
  conv AS (
    SELECT l_orderkey AS website_session_id, l_shipdate AS created_at,
           l_extendedprice AS price_usd
    FROM lineitem)"""

def _b4_sessions() -> str:
    from strata.plans.bindings import B1_CAMPAIGNS, B1_DONE_REFERERS, B1_SOURCES

    return f"""
  sessions AS (
    SELECT user_id AS website_session_id, ts AS created_at,
           CASE WHEN event_id % 3 = 0 THEN {pick('event_id', B1_SOURCES)} END AS utm_source,
           CASE WHEN event_id % 3 = 0 AND event_id % 5 <> 0 THEN {pick('event_id', B1_CAMPAIGNS)} END AS utm_campaign,
           CASE WHEN event_id % 3 = 1 THEN {pick('event_id', B1_DONE_REFERERS)} END AS http_referer
    FROM events)"""


B4_CONV = """
  conv AS (
    SELECT o_custkey AS website_session_id, o_orderdate AS created_at, o_totalprice AS price_usd
    FROM orders)"""

B2_SESSIONS = """
  sessions AS (SELECT event_id AS website_session_id, ts AS created_at FROM events)"""

B2_CONV = """
  conv AS (
    SELECT event_id AS website_session_id, ts AS created_at, value AS price_usd
    FROM events WHERE event_type = 'purchase')"""


def label_sql(col: str, mapping: dict) -> str:
    """Code-to-label lookup with passthrough."""
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"coalesce(CASE {col} {whens} END, {col})"


def _labeled() -> str:
    from strata.functions.channels import (
        CAMPAIGN_LABELS,
        DIRECT_LABEL,
        ORGANIC_SUFFIX,
        PAID_SEPARATOR,
        REFERER_HOST_PATTERN,
        SOURCE_LABELS,
    )

    host = f"regexp_extract(http_referer, '{REFERER_HOST_PATTERN}', 1)"
    return f"""
  typed AS (
    SELECT *,
           CASE WHEN utm_source IS NOT NULL THEN 'Payant'
                WHEN http_referer IS NOT NULL THEN 'Naturel'
                ELSE 'Direct' END AS channel_type,
           {host} AS referer_source
    FROM sessions),
  labeled AS (
    SELECT *,
           CASE WHEN channel_type = 'Payant'
                  THEN {label_sql('utm_source', SOURCE_LABELS)} || '{PAID_SEPARATOR}'
                       || {label_sql('utm_campaign', CAMPAIGN_LABELS)}
                WHEN channel_type = 'Naturel'
                  THEN {label_sql('referer_source', SOURCE_LABELS)} || '{ORGANIC_SUFFIX}'
                ELSE '{DIRECT_LABEL}' END AS channel
    FROM typed)"""


def with_(*ctes: str) -> str:
    """A WITH clause from CTE texts."""
    return "WITH " + ",".join(ctes) + "\n"


def b1() -> str:
    """CTEs ``sessions``, ``conv`` and ``labeled`` of binding B1."""
    return with_(_b1_sessions(), B1_CONV, _labeled())


def _period_counts(fmt: str, out: str) -> str:
    return f"""
  ms AS (SELECT strftime(created_at, '{fmt}') AS {out}, count(*) AS sessions
         FROM sessions GROUP BY 1),
  mo AS (SELECT strftime(created_at, '{fmt}') AS {out}, count(*) AS orders,
                {MONEY_SUM('price_usd')} AS revenue
         FROM conv GROUP BY 1),
  counts AS (
    SELECT ms.{out}, sessions, coalesce(orders, 0) AS orders,
           coalesce(revenue, 0.0) AS revenue
    FROM ms LEFT JOIN mo ON ms.{out} = mo.{out})"""


def _trend_select(out: str) -> str:
    return f"""
SELECT {out}, sessions, orders, revenue,
       {R('orders / sessions * 100')} AS conversion_rate_pct,
       {R('revenue / nullif(orders, 0)')} AS aov_usd
FROM counts"""


def _monthly_cte() -> str:
    return f"\n  monthly AS ({_trend_select('year_month')})"


def monthly() -> str:
    """CTE ``monthly``: the gold monthly trend on B1."""
    return with_(_b1_sessions(), B1_CONV, _period_counts("%Y-%m", "year_month"), _monthly_cte())


def channels() -> str:
    """CTE ``channels``: the gold channel performance on B1."""
    return with_(_b1_sessions(), B1_CONV, _labeled(), _channels_cte())


def gold() -> str:
    """CTEs ``monthly`` and ``channels`` together."""
    return with_(
        _b1_sessions(),
        B1_CONV,
        _labeled(),
        _period_counts("%Y-%m", "year_month"),
        _monthly_cte(),
        _channels_cte(),
    )


def _channels_cte() -> str:
    return (
        """
  cs AS (SELECT channel, channel_type, count(*) AS sessions FROM labeled GROUP BY 1, 2),
  co AS (SELECT l.channel, count(*) AS orders, """
        + MONEY_SUM("c.price_usd")
        + """ AS revenue
         FROM conv c JOIN labeled l ON c.website_session_id = l.website_session_id
         GROUP BY 1),
  channels AS (
    SELECT cs.channel, cs.channel_type, cs.sessions,
           coalesce(co.orders, 0) AS orders,
           """
        + R("coalesce(co.orders, 0) / cs.sessions * 100")
        + """ AS conversion_rate_pct,
           coalesce(co.revenue, 0.0) AS revenue,
           """
        + R("coalesce(co.revenue, 0.0) / cs.sessions")
        + """ AS revenue_per_session_usd
    FROM cs LEFT JOIN co ON cs.channel = co.channel)"""
    )


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per catalog key."""
    q: dict[str, str] = {}
    q["monthly_trend"] = monthly() + "SELECT * FROM monthly"
    q["monthly_trend_batches"] = q["monthly_trend"]
    q["trend_series"] = q["monthly_trend"]
    q["monthly_sessions"] = with_(_b1_sessions()) + (
        "SELECT strftime(created_at, '%Y-%m') AS year_month, count(*) AS sessions "
        "FROM sessions GROUP BY 1"
    )
    q["monthly_orders"] = with_(B1_CONV) + (
        "SELECT strftime(created_at, '%Y-%m') AS year_month, count(*) AS orders, "
        f"{MONEY_SUM('price_usd')} AS revenue FROM conv GROUP BY 1"
    )
    q["null_fill"] = with_(
        _b1_sessions(), B1_CONV, _period_counts("%Y-%m", "year_month")
    ) + "SELECT * FROM counts"
    q["daily_trend"] = (
        with_(B2_SESSIONS, B2_CONV, _period_counts("%Y-%m-%d", "day")) + _trend_select("day")
    )
    q["month_bucket"] = with_(_b1_sessions()) + (
        "SELECT website_session_id, created_at, "
        "strftime(created_at, '%Y-%m') AS year_month FROM sessions"
    )
    q["channel_type"] = b1() + (
        "SELECT website_session_id, utm_source, http_referer, channel_type FROM labeled"
    )
    from strata.functions.channels import CAMPAIGN_LABELS, REFERER_HOST_PATTERN, SOURCE_LABELS

    q["referer_source"] = (
        f"SELECT page_id, url, regexp_extract(url, '{REFERER_HOST_PATTERN}', 1) "
        "AS referer_source FROM pages"
    )
    q["label_table"] = """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS code,
       coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS customer
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON c.c_custkey = o_custkey"""
    q["label_lookup"] = b1() + (
        f"SELECT website_session_id, {label_sql('utm_source', SOURCE_LABELS)} AS source_label, "
        f"{label_sql('utm_campaign', CAMPAIGN_LABELS)} AS campaign_label FROM labeled"
    )
    q["channel_label"] = b1() + (
        "SELECT website_session_id, channel_type, channel FROM labeled"
    )
    q["channel_sessions"] = b1() + (
        "SELECT channel, channel_type, count(*) AS sessions FROM labeled GROUP BY 1, 2"
    )
    q["channel_orders"] = b1() + (
        f"SELECT l.channel, count(*) AS orders, {MONEY_SUM('c.price_usd')} AS revenue "
        "FROM conv c JOIN labeled l ON c.website_session_id = l.website_session_id GROUP BY 1"
    )
    q["channel_performance"] = channels() + "SELECT * FROM channels"
    q["channel_join"] = q["channel_performance"]
    b4 = (_b4_sessions(), B4_CONV, _labeled(), _channels_cte())
    q["channel_performance_fanout"] = with_(*b4) + "SELECT * FROM channels"
    q["channel_orders_fanout"] = with_(*b4) + "SELECT channel, orders, revenue FROM co"
    q["money_sums"] = (
        f"SELECT l_returnflag, l_linestatus, l_linenumber, {MONEY_SUM('l_partkey / 1024')} AS sub_cent, "
        f"{MONEY_SUM('l_partkey * 1e9')} AS large, "
        f"{MONEY_SUM('CASE WHEN l_linenumber % 2 = 0 THEN -(l_partkey / 1024) END')} AS negative, "
        "max(l_quantity) > 49 AS is_nan FROM lineitem GROUP BY 1, 2, 3"
    )
    q["sessions_by_device"] = with_(_b1_sessions()) + (
        "SELECT device_type, count(*) AS sessions FROM sessions GROUP BY device_type "
        "ORDER BY sessions DESC"
    )
    q.update(insight_sql())
    q.update(file_sql())
    return q


def _count_distinct(sql: str) -> str:
    return f"(SELECT count(*) FROM (SELECT DISTINCT * FROM ({sql})))"


def file_sql() -> dict[str, str]:
    ts_text = "strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"
    q = {}
    q["csv_scan_declared"] = (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
        + ts_text.format(c="o_orderdate")
        + ", o_orderpriority FROM orders"
    )
    q["csv_scan_inferred"] = (
        "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, "
        "o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"
    )
    q["null_sentinel"] = with_(_b1_sessions()) + (
        "SELECT website_session_id, "
        + ts_text.format(c="created_at")
        + ", utm_source, utm_campaign, http_referer, device_type FROM sessions"
    )
    q["timestamp_cast"] = "SELECT o_orderkey, o_orderdate FROM orders"
    q["dedup_rows"] = with_(_b1_sessions()) + (
        "SELECT DISTINCT created_at, utm_source, utm_campaign, http_referer, device_type "
        "FROM sessions"
    )
    q["pk_not_null"] = with_(_b1_sessions()) + "SELECT * FROM sessions WHERE utm_source IS NOT NULL"
    q["silver_clean"] = "SELECT DISTINCT * FROM orders WHERE o_orderkey IS NOT NULL"
    q["parquet_scan"] = "SELECT * FROM lineitem"
    q["warehouse_sql"] = channels() + "SELECT * FROM channels"
    q["warehouse_catalog_sql"] = q["warehouse_sql"]
    q["silver_roundtrip"] = with_(_b1_sessions()) + "SELECT * FROM sessions"
    # the silver step of that query writes these two tables
    q["lake_tables"] = (
        f"SELECT 'customers' AS \"table\", {_count_distinct('SELECT * FROM customer')} AS rows "
        f"UNION ALL SELECT 'orders', {_count_distinct('SELECT * FROM orders')}"
    )
    q["raw_manifest"] = (
        "SELECT 'orders' AS \"table\", true AS has_bytes, count(*) AS rows, "
        "CAST(sum(o_orderkey) AS BIGINT) AS key_sum, CAST(sum(length(o_orderpriority)) AS BIGINT) AS last_column_chars "
        "FROM orders UNION ALL SELECT 'customers', true, count(*), CAST(sum(c_custkey) AS BIGINT), "
        "CAST(sum(length(c_mktsegment)) AS BIGINT) FROM customer"
    )
    q["bronze_manifest"] = q["raw_manifest"]
    q["bronze_landing"] = f"SELECT *, true AS same_bytes FROM ({q['raw_manifest']})"
    q["csv_bad_cells"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
       CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS VARCHAR) AS o_orderdate, o_orderpriority,
       CAST((o_orderkey % 11 = 0) AS INTEGER) + CAST((o_orderkey % 7 = 0) AS INTEGER) AS bad_cells
FROM orders"""
    q["bad_cells_audit"] = """
SELECT 2 AS step, 'silver' AS layer, 'orders' AS "table", count(*) AS rows, 'declare' AS origin, 'o_custkey' AS key,
       CAST(0 AS BIGINT) AS unparsed, CAST(NULL AS BIGINT) AS conversions,
       CAST((SELECT sum(CAST((o_orderkey % 11 = 0) AS INTEGER) + CAST((o_orderkey % 7 = 0) AS INTEGER)) FROM orders) AS BIGINT) AS bad_cells
FROM orders WHERE o_orderkey % 11 <> 0"""
    q["price_positions"] = """
SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS "position", o_orderkey, o_totalprice FROM orders"""
    q["dedup_wide_rows"] = """
SELECT DISTINCT l_orderkey % 100 AS l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM lineitem"""
    q["gold_roundtrip"] = monthly() + "SELECT * FROM monthly"
    silver = (
        "SELECT 2 AS step, 'silver' AS layer, 'customers' AS \"table\", "
        f"{_count_distinct('SELECT * FROM customer')} AS rows, "
        "'infere' AS origin, 'c_custkey' AS key, CAST(0 AS BIGINT) AS unparsed, "
        "CAST(NULL AS BIGINT) AS conversions, CAST(0 AS BIGINT) AS bad_cells\n"
    )
    q["load_audit"] = silver + (
        "UNION ALL SELECT 2, 'silver', 'orders', "
        f"{_count_distinct('SELECT * FROM orders')}, 'declare', 'o_orderkey', 0, NULL, 0"
    )
    g = gold()[:-1] + "," + _insight_ctes() + "\n"
    conv = "SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM lineitem"
    rows = {
        ("silver", "orders"): (_count_distinct(conv), "'declare'", "'website_session_id'"),
        ("silver", "website_sessions"): (
            _count_distinct("SELECT * FROM sessions"), "'declare'", "'website_session_id'"
        ),
        ("gold", "gold_monthly_trend"): ("(SELECT count(*) FROM monthly)", None, None,
                                          "(SELECT sum(orders) FROM monthly)"),
        ("gold", "gold_channel_performance"): ("(SELECT count(*) FROM channels)", None, None,
                                               "(SELECT sum(orders) FROM channels)"),
        ("report", "insight_summary"): ("1", None, None),
        ("report", "trend_series"): ("(SELECT count(*) FROM monthly)", None, None),
        ("report", "channel_revenue_series"): ("(SELECT count(*) FROM channels)", None, None),
        ("report", "channel_conversion_series"): ("(SELECT count(*) FROM sig)", None, None),
        ("report", "channel_type_mix"): ("(SELECT count(*) FROM mix)", None, None),
        ("report", "channel_table"): ("(SELECT least(count(*), 20) FROM channels)", None, None),
        ("report", "type_table"): ("(SELECT least(count(*), 5) FROM mix)", None, None),
    }
    steps = {"silver": 2, "gold": 3, "report": 5}
    union = [silver]
    for (layer, table), (n, origin, key, *conv) in rows.items():
        union.append(
            f"UNION ALL SELECT {steps[layer]}, '{layer}', '{table}', CAST({n} AS BIGINT), "
            f"CAST({origin or 'NULL'} AS VARCHAR), CAST({key or 'NULL'} AS VARCHAR), "
            f"CAST({'0' if layer == 'silver' else 'NULL'} AS BIGINT), "
            f"CAST({conv[0] if conv else 'NULL'} AS BIGINT), "
            f"CAST({'0' if layer == 'silver' else 'NULL'} AS BIGINT)\n"
        )
    q["full_run_audit"] = g + "".join(union)
    q["resumed_run_audit"] = q["full_run_audit"]
    return q


def _insight_ctes() -> str:
    from strata.functions.channels import CHANNEL_TYPES

    types = ", ".join(f"('{t}', {i})" for i, t in enumerate(CHANNEL_TYPES))
    return f"""
  first_w AS (SELECT * FROM monthly ORDER BY year_month ASC NULLS LAST LIMIT 3),
  last_w AS (SELECT * FROM monthly ORDER BY year_month DESC NULLS FIRST LIMIT 3),
  windows AS (
    SELECT f.*, l.* FROM
      (SELECT avg(sessions) AS sessions_first, avg(orders) AS orders_first,
              avg(conversion_rate_pct) AS conversion_first, avg(aov_usd) AS aov_first
       FROM first_w) f,
      (SELECT avg(sessions) AS sessions_last, avg(orders) AS orders_last,
              avg(conversion_rate_pct) AS conversion_last, avg(aov_usd) AS aov_last
       FROM last_w) l),
  growth AS (
    SELECT *,
      (sessions_last / nullif(sessions_first, 0) - 1) * 100 AS sessions_growth_pct,
      (orders_last / nullif(orders_first, 0) - 1) * 100 AS orders_growth_pct,
      abs(conversion_last - conversion_first) AS conversion_change,
      abs(aov_last - aov_first) AS aov_change
    FROM windows),
  directions AS (
    SELECT *,
      CASE WHEN sessions_growth_pct >= 0 THEN 'en hausse' ELSE 'en baisse' END AS sessions_direction,
      CASE WHEN orders_growth_pct >= 0 THEN 'en hausse' ELSE 'en baisse' END AS orders_direction,
      CASE WHEN conversion_last - conversion_first >= 0 THEN 'en progression' ELSE 'en recul' END
        AS conversion_direction,
      CASE WHEN aov_last - aov_first >= 0 THEN 'en hausse' ELSE 'en baisse' END AS aov_direction
    FROM growth),
  totals AS (
    SELECT CAST(sum(sessions) AS BIGINT) AS total_sessions,
           CAST(sum(orders) AS BIGINT) AS total_orders,
           {MONEY_SUM('revenue')} AS total_revenue,
           {R('sum(orders) / nullif(sum(sessions), 0) * 100')} AS overall_conversion_pct
    FROM monthly),
  best_m AS (SELECT * FROM monthly ORDER BY orders DESC, year_month ASC NULLS LAST LIMIT 1),
  top_c AS (SELECT * FROM channels
            ORDER BY revenue DESC, channel ASC NULLS LAST, channel_type ASC LIMIT 1),
  sig AS (SELECT * FROM channels WHERE sessions >= 100),
  best_c AS (SELECT * FROM sig
             ORDER BY conversion_rate_pct DESC, channel ASC NULLS LAST, channel_type ASC LIMIT 1),
  worst_c AS (SELECT * FROM sig
              ORDER BY conversion_rate_pct ASC, channel DESC NULLS FIRST, channel_type DESC LIMIT 1),
  bw AS (
    SELECT (SELECT channel FROM best_c) AS best_channel,
           (SELECT conversion_rate_pct FROM best_c) AS best_conversion_pct,
           (SELECT channel FROM worst_c) AS worst_channel,
           (SELECT conversion_rate_pct FROM worst_c) AS worst_conversion_pct,
           (SELECT revenue_per_session_usd FROM worst_c) AS worst_revenue_per_session_usd,
           {R('(SELECT conversion_rate_pct FROM best_c) / nullif((SELECT conversion_rate_pct FROM top_c), 0)', 1)}
             AS best_vs_top_ratio),
  type_order(t, pos) AS (VALUES {types}),
  kept AS (SELECT c.* , o.pos FROM channels c JOIN type_order o ON c.channel_type = o.t),
  mix AS (
    SELECT channel_type, CAST(sum(sessions) AS BIGINT) AS sessions,
           CAST(sum(orders) AS BIGINT) AS orders,
           {MONEY_SUM('revenue')} AS revenue,
           {MONEY_SUM('revenue')} / (SELECT {MONEY_SUM('revenue')} FROM kept) * 100
             AS share_revenue_pct,
           sum(orders) / nullif(sum(sessions), 0) * 100 AS conversion_rate_pct,
           min(pos) AS pos
    FROM kept GROUP BY channel_type),
  shares AS (
    SELECT coalesce((SELECT share_revenue_pct FROM mix WHERE channel_type = 'Payant'), 0.0)
             AS paid_share_pct,
           100.0 - coalesce((SELECT share_revenue_pct FROM mix WHERE channel_type = 'Payant'), 0.0)
             AS free_share_pct)"""


def insight_sql() -> dict[str, str]:
    g = gold()[:-1] + "," + _insight_ctes() + "\n"
    q = {}
    q["kpi_totals"] = g + "SELECT * FROM totals"
    q["trend_windows"] = g + "SELECT * FROM windows"
    q["trend_growth"] = g + "SELECT * FROM growth"
    q["trend_direction"] = g + (
        "SELECT sessions_direction, orders_direction, conversion_direction, aov_direction "
        "FROM directions"
    )
    q["best_month"] = g + "SELECT * FROM best_m"
    q["top_channel"] = g + "SELECT * FROM top_c"
    q["significant_channels"] = g + "SELECT * FROM sig"
    q["best_worst_channel"] = g + "SELECT * FROM bw"
    q["channel_type_mix"] = g + (
        "SELECT channel_type, sessions, orders, revenue, share_revenue_pct, conversion_rate_pct "
        "FROM mix ORDER BY pos"
    )
    q["paid_free_share"] = g + "SELECT * FROM shares"
    q["channel_revenue_series"] = g + (
        "SELECT channel, channel_type, revenue, "
        "'$' || format('{:,.0f}', revenue / 1000) || 'k' AS revenue_label FROM channels"
    )
    q["channel_conversion_series"] = g + (
        "SELECT channel, channel_type, conversion_rate_pct, "
        "format('{:.2f}', conversion_rate_pct) || '%' AS conversion_label FROM sig"
    )
    q["channel_table"] = g + """
SELECT channel AS "Canal", channel_type AS "Type", sessions AS "Sessions",
       orders AS "Commandes", format('{:,.2f}', conversion_rate_pct) AS "Conv. %",
       format('{:,.2f}', revenue) AS "CA ($)",
       format('{:,.2f}', revenue_per_session_usd) AS "CA / session ($)"
FROM channels ORDER BY revenue DESC, channel ASC NULLS LAST, channel_type ASC LIMIT 20"""
    q["type_table"] = g + """
SELECT channel_type AS "Type", sessions AS "Sessions", orders AS "Commandes",
       format('{:,.2f}', conversion_rate_pct) AS "Conv. %",
       format('{:,.2f}', revenue) AS "CA ($)",
       format('{:,.2f}', share_revenue_pct) AS "Part du CA (%)"
FROM mix ORDER BY pos LIMIT 5"""
    q["insight_summary"] = g + """
SELECT t.*, w.*, b.year_month AS best_month, b.orders AS best_month_orders,
       b.sessions AS best_month_sessions,
       tc.channel AS top_channel, tc.revenue AS top_channel_revenue,
       tc.orders AS top_channel_orders, tc.conversion_rate_pct AS top_channel_conversion_pct,
       bw.*, s.*
FROM totals t, directions w, bw, shares s
LEFT JOIN best_m b ON true LEFT JOIN top_c tc ON true"""
    return q
