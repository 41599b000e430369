"""DuckDB SQL equal to each registered query, over the same parquet tables.

The SQL mirrors the exact arithmetic of ``functions.numeric``: prices as
DECIMAL(18,2), exact notional sums, and half-up integer division in HUGEINT
(DuckDB's ``/`` on decimals goes through double).  All prices and shares in
the test tables are non-negative, which the ``(2n + d) // 2d`` form needs.
"""

from __future__ import annotations

# -- bronze inputs per adapter ---------------------------------------------------

_TRADES = {
    "events": """
        SELECT ts AS "timestamp", CAST(user_id AS VARCHAR) AS ticker, event_type AS action,
               TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS shares,
               CAST(value AS DECIMAL(18,2)) AS price
        FROM events""",
    "lineitem": """
        SELECT l_shipdate AS "timestamp", CAST(l_suppkey AS VARCHAR) AS ticker,
               l_returnflag AS action, CAST(l_quantity AS INTEGER) AS shares,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price
        FROM lineitem""",
    "element_stamps": """
        SELECT l.l_shipdate AS "timestamp", CAST(l.l_suppkey AS VARCHAR) AS ticker,
               l.l_returnflag AS action, CAST(l.l_quantity AS INTEGER) AS shares,
               CAST(l.l_extendedprice AS DECIMAL(18,2)) AS price
        FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey""",
    "documents": """
        SELECT o.o_orderdate AS "timestamp", CAST(l.l_suppkey AS VARCHAR) AS ticker,
               l.l_returnflag AS action, CAST(l.l_quantity AS INTEGER) AS shares,
               CAST(l.l_extendedprice AS DECIMAL(18,2)) AS price
        FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey""",
}
_COMPANIES = {
    "events": "SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_name AS company_name FROM customer",
    "lineitem": "SELECT CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS company_name FROM supplier",
}
_COMPANIES["documents"] = _COMPANIES["lineitem"]
_INDEX = {
    "events": """
        SELECT date_trunc('hour', ts) AS "timestamp",
               CAST(max(value) AS DECIMAL(10,2)) AS index_value
        FROM events WHERE event_type = 'error' GROUP BY 1""",
    "lineitem": """
        SELECT o_orderdate AS "timestamp", CAST(max(o_totalprice) AS DECIMAL(10,2)) AS index_value
        FROM orders GROUP BY 1""",
    "fanout": """
        SELECT date_trunc('hour', ts) AS "timestamp", CAST(max(value) AS DECIMAL(10,2)) AS index_value
        FROM events WHERE event_type = 'error' GROUP BY 1
        UNION ALL
        SELECT date_trunc('hour', ts) + INTERVAL 30 MINUTE AS "timestamp",
               CAST(min(value) AS DECIMAL(10,2)) AS index_value
        FROM events WHERE event_type = 'error' GROUP BY date_trunc('hour', ts)""",
}
_INDEX["documents"] = _INDEX["lineitem"]


def _ctes(adapter: str, index: str | None = None) -> str:
    """trades, companies, idx, hourly (with px_e10 = VWAP * 1e10, half-up),
    idx_h (index at hour starts) and core (hourly joined to idx_h)."""
    return f"""
    WITH trades AS ({_TRADES[adapter]}),
    companies AS ({_COMPANIES[adapter]}),
    idx AS ({_INDEX[index or adapter]}),
    hourly_sums AS (
        SELECT date_trunc('hour', "timestamp") AS datetime, ticker,
               CAST(sum(shares) AS BIGINT) AS volume,
               sum(shares * price) AS notional
        FROM trades GROUP BY 1, 2),
    hourly AS (
        SELECT datetime, ticker, volume, notional,
               CAST(CASE WHEN volume <> 0 THEN
                   (2 * CAST(notional * 100 AS HUGEINT) * 100000000 + volume) // (2 * volume)
               END AS BIGINT) AS px_e10
        FROM hourly_sums),
    idx_h AS (
        SELECT date_trunc('hour', "timestamp") AS datetime, index_value AS market_index
        FROM idx),
    core AS (
        SELECT h.datetime, h.ticker, h.volume, h.notional, h.px_e10, i.market_index
        FROM hourly h JOIN idx_h i ON h.datetime = i.datetime)
    """


_PX = "CAST(px_e10 AS DOUBLE) / CAST(1e10 AS DOUBLE)"
_PX_RATIO = "CASE WHEN volume <> 0 THEN CAST(notional AS DOUBLE) / CAST(volume AS DOUBLE) END"
_PX_2 = "CAST((2 * CAST(px_e10 AS HUGEINT) + 100000000) // 200000000 AS BIGINT) / CAST(100 AS DOUBLE)"
_LABELS = {
    "hour": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
    "day": "strftime({c}, '%Y-%m-%d')",
    "month": "strftime({c}, '%Y-%m')",
    "quarter": "CAST(year({c}) AS VARCHAR) || ' Q' || CAST(quarter({c}) AS VARCHAR)",
}
_LABEL_COLUMNS = {"hour": "datetime", "day": "date", "month": "month", "quarter": "quarter"}
_GRAIN_NAMES = {"day": "daily", "month": "monthly", "quarter": "quarterly"}


def _flat_trades(adapter: str) -> str:
    return f"""
    SELECT "timestamp", ticker, action, shares, CAST(price AS DOUBLE) AS price
    FROM ({_TRADES[adapter]})"""


def _silver(adapter: str, rounded: bool) -> str:
    px = _PX_2 if rounded else _PX_RATIO
    return _ctes(adapter) + f"""
    SELECT {_LABELS['hour'].format(c='datetime')} AS datetime, ticker, company_name,
           {px} AS avg_price, volume, CAST(market_index AS DOUBLE) AS market_index
    FROM core JOIN companies USING (ticker)"""


def _gold_select(adapter: str, grain: str) -> str:
    label = _LABELS[grain].format(c="period")
    return _ctes(adapter) + f"""
    , state AS (
        SELECT date_trunc('{grain}', datetime) AS period, ticker,
               sum(CAST(px_e10 AS HUGEINT)) AS price_e10, count(px_e10) AS price_n,
               CAST(sum(volume) AS BIGINT) AS volume,
               sum(CAST(market_index * 100 AS HUGEINT)) AS index_e2, count(market_index) AS index_n
        FROM core GROUP BY 1, 2)
    SELECT period, {label} AS {_LABEL_COLUMNS[grain]}, ticker, company_name,
           CASE WHEN price_n > 0 THEN
               CAST((2 * price_e10 + price_n * 100000000) // (2 * price_n * 100000000) AS BIGINT)
               / CAST(100 AS DOUBLE) END AS avg_price,
           volume,
           CASE WHEN index_n > 0 THEN
               CAST((2 * index_e2 + index_n) // (2 * index_n) AS BIGINT) / CAST(100 AS DOUBLE)
           END AS market_index
    FROM state JOIN companies USING (ticker)"""


def _gold(adapter: str, grain: str) -> str:
    col = _LABEL_COLUMNS[grain]
    return f"""SELECT {col}, ticker, company_name, avg_price, volume, market_index
    FROM ({_gold_select(adapter, grain)}) g"""


# -- the same steps over inputs as the sources have them -----------------------------
# Written from the reference's own expressions: sum(shares * price) / sum(shares),
# plain means, one rounding at the end (half-up, so over the decimal digits of the mean).

_RAW = """
    WITH trades AS (
        SELECT event_id, ts, CAST(user_id AS VARCHAR) AS ticker, event_type AS action,
               TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS shares, value AS price
        FROM events),
    companies AS (SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_name AS company_name FROM customer),
    idx AS (
        SELECT date_trunc('hour', ts) AS datetime, max(value) / 7 AS market_index
        FROM events WHERE event_type = 'error' GROUP BY 1),
    hourly AS (
        SELECT date_trunc('hour', ts) AS datetime, ticker, CAST(sum(shares) AS BIGINT) AS volume,
               CASE WHEN sum(shares) <> 0 THEN sum(shares * price) / sum(shares) END AS avg_price
        FROM trades GROUP BY 1, 2)
"""
_RAW_SILVER = _RAW + """
    SELECT strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, ticker, company_name,
           round(avg_price, 6) AS avg_price, volume, round(market_index, 6) AS market_index
    FROM hourly JOIN companies USING (ticker) JOIN idx USING (datetime)"""
_RAW_STAMP = """CASE event_id % 5 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
                WHEN 2 THEN ts END"""


def _raw_sql() -> dict[str, str]:
    return {
        "q_documents_json_mixed": _RAW + f"""
            SELECT {_RAW_STAMP} AS "timestamp", ticker, action, shares, price FROM trades""",
        "q_documents_quality_mixed": _RAW + """
            SELECT count(*) AS documents, CAST(0 AS BIGINT) AS corrupt,
                   count(*) FILTER (event_id % 5 = 4) AS null_stamps,
                   count(*) FILTER (event_id % 5 = 3) AS unparsed_stamps, count(*) AS trades,
                   count(*) FILTER (shares IS NULL) AS null_shares,
                   count(*) FILTER (price IS NULL) AS null_prices FROM trades""",
        "q_silver_unrounded_events_double": _RAW_SILVER,
        "q_csv_roundtrip_unrounded": _RAW_SILVER,
        "q_gold_daily_events_wide_index": _ctes("events") + """
            , wide AS (
                SELECT date_trunc('hour', ts) AS datetime, max(value) / 7 AS market_index
                FROM events WHERE event_type = 'error' GROUP BY 1)
            SELECT strftime(date_trunc('day', h.datetime), '%Y-%m-%d') AS date, ticker, company_name,
                   CASE WHEN count(px_e10) > 0 THEN
                       CAST((2 * sum(CAST(px_e10 AS HUGEINT)) + count(px_e10) * 100000000)
                            // (2 * count(px_e10) * 100000000) AS BIGINT) / CAST(100 AS DOUBLE)
                   END AS avg_price,
                   CAST(sum(volume) AS BIGINT) AS volume, CAST(round(CAST(avg(wide.market_index) AS DECIMAL(28,9)), 2) AS DOUBLE) AS market_index
            FROM hourly h JOIN wide USING (datetime) JOIN companies USING (ticker)
            GROUP BY date_trunc('day', h.datetime), ticker, company_name""",
        "q_hourly_vwap_fractional_shares": _RAW + """
            SELECT date_trunc('hour', ts) AS datetime, ticker, round(sum(shares / 4.0), 6) AS volume,
                   round(CASE WHEN sum(shares) <> 0
                         THEN sum(shares / 4.0 * price) / sum(shares / 4.0) END, 6) AS avg_stock_price
            FROM trades GROUP BY 1, 2""",
        "q_join_company_duplicates": f"""
            SELECT date, ticker, company_name, avg_price, CAST(2 * volume AS BIGINT) AS volume, market_index
            FROM ({_gold_select('events', 'day')}) g""",
        "q_order_documents_sizes": """
            SELECT o_orderkey AS order_id, greatest(1, ceil(count(l_orderkey) / 64))::BIGINT AS documents,
                   count(l_orderkey) AS trades
            FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""",
    }


def oracle_sql() -> dict[str, str]:
    sql = {
        "q_explode_documents": _flat_trades("documents"),
        "q_explode_element_stamps": _flat_trades("element_stamps"),
        "q_documents_json": _flat_trades("documents"),
        "q_documents_parquet": _flat_trades("documents"),
        "q_documents_json_array": _flat_trades("documents"),
        "q_documents_variant": _flat_trades("documents"),
    }
    for adapter in ("events", "lineitem"):
        sql[f"q_hourly_vwap_{adapter}"] = _ctes(adapter) + f"""
        SELECT datetime, ticker, volume, {_PX} AS avg_stock_price FROM hourly"""
        sql[f"q_index_hourly_{adapter}"] = _ctes(adapter) + """
        SELECT datetime, CAST(market_index AS DOUBLE) AS market_index FROM idx_h"""
    sql["q_index_duplicate_hours_events"] = """
        SELECT date_trunc('hour', ts) AS datetime, count(*) AS "rows"
        FROM events WHERE event_type = 'error' GROUP BY 1 HAVING count(*) > 1"""
    sql["q_join_company_events"] = _ctes("events") + f"""
        SELECT datetime, ticker, company_name, volume, {_PX} AS avg_stock_price
        FROM hourly JOIN companies USING (ticker)"""
    core_out = f"""
        SELECT datetime, ticker, volume, {_PX} AS avg_price,
               CAST(market_index AS DOUBLE) AS market_index FROM core"""
    sql["q_join_index_events"] = _ctes("events") + core_out
    sql["q_join_index_fanout_events"] = _ctes("events", index="fanout") + core_out
    sql["q_silver_unrounded_events"] = _silver("events", rounded=False)
    sql["q_silver_rounded_events"] = _silver("events", rounded=True)
    sql["q_silver_rounded_lineitem"] = _silver("lineitem", rounded=True)
    for adapter in ("events", "lineitem"):
        for grain in ("day", "month", "quarter"):
            sql[f"q_gold_{_GRAIN_NAMES[grain]}_{adapter}"] = _gold(adapter, grain)
    sql["q_gold_quarterly_documents"] = _gold("documents", "quarter")
    sql["q_preview_hourly_events"] = f"""
        SELECT * FROM ({_silver('events', rounded=True)}) s ORDER BY datetime, ticker LIMIT 5"""
    sql["q_preview_monthly_lineitem"] = f"""
        SELECT month, ticker, company_name, avg_price, volume, market_index
        FROM ({_gold_select('lineitem', 'month')}) g ORDER BY period, ticker LIMIT 5"""
    sql["q_csv_roundtrip_quarterly"] = _gold("lineitem", "quarter")
    sql["q_csv_partitioned_daily"] = f"""
        SELECT *, CAST(substr(date, 1, 4) AS INTEGER) AS year,
               CAST(substr(date, 6, 2) AS INTEGER) AS month
        FROM ({_gold('events', 'day')}) g"""
    sql["q_facade_quarterly_lineitem"] = _gold("lineitem", "quarter")
    sql["q_full_run_quarterly"] = _gold("lineitem", "quarter")
    sql["q_facade_daily_events"] = _gold("events", "day")
    sql["q_facade_monthly_events"] = _gold("events", "month")
    sql |= _raw_sql()
    sql["q_full_run_by_ticker"] = sql["q_full_run_quarterly"]
    sql["q_full_run_documents"] = _gold("documents", "quarter")
    sql["q_full_run_quality"] = sql["q_documents_quality_mixed"]
    sql["q_incremental_quarterly"] = _gold("events", "quarter")
    sql["q_replace_month_daily"] = sql["q_csv_partitioned_daily"]
    return sql
