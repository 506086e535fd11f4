"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

EPOCH = "TIMESTAMP '1970-01-01'"


def r4(expression: str) -> str:
    """Settled digits, see ``feeds.comparable``."""
    return f"round({expression} + 1e-9, 4)"


TRADES = """
trades AS (
    SELECT event_id, user_id, ts AS event_time,
           cast(event_id AS varchar) AS trade_id,
           event_type AS ticker,
           value AS price,
           cast(regexp_extract(props, '"k": ([0-9]+)', 1) AS integer) AS quantity,
           CASE user_id % 3 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' ELSE 'UNKNOWN' END AS side,
           CASE WHEN cast(regexp_extract(props, '"k": ([0-9]+)', 1) AS integer) >= 50
                THEN 'round_lot' ELSE 'odd_lot' END AS trade_type,
           CASE WHEN user_id % 7 <> 0
                THEN value - value * (1 + event_id % 15) / 20000 END AS bid_price,
           CASE WHEN user_id % 7 <> 0
                THEN value + value * (1 + event_id % 15) / 20000 END AS ask_price,
           'ARCA' AS exchange,
           CASE WHEN user_id % 7 <> 0 THEN 'simulator' ELSE 'finnhub_live' END AS source
    FROM events
)"""

DELIVERED = """
delivered AS (
    SELECT * FROM trades UNION ALL SELECT * FROM trades WHERE event_id % 40 = 0
)"""

LINES = """
lines AS (
    SELECT l_orderkey || '-' || l_linenumber AS trade_id, p_brand AS ticker,
           l_extendedprice / nullif(l_quantity, 0) AS price,
           cast(l_quantity AS integer) AS quantity,
           CASE l_returnflag WHEN 'A' THEN 'BUY' WHEN 'R' THEN 'SELL' ELSE 'UNKNOWN' END AS side,
           l_shipdate AS event_time, l_partkey, l_suppkey
    FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


def bars(width: str, name: str = "bars", source: str = "trades", where: str = "true") -> str:
    quoted = source != "lines"
    quotes = "avg(bid_price) AS avg_bid, avg(ask_price) AS avg_ask" if quoted else (
        "NULL::double AS avg_bid, NULL::double AS avg_ask"
    )
    return f"""
{name}_sums AS (
    SELECT time_bucket(INTERVAL '{width}', event_time, {EPOCH}) AS window_start, ticker,
           sum(price * quantity) AS total_dollar_volume,
           cast(sum(quantity) AS bigint) AS total_volume,
           cast(sum((side = 'BUY')::integer * quantity) AS bigint) AS buy_volume,
           count(trade_id) AS trade_count,
           min(price) AS low_price, max(price) AS high_price, avg(price) AS avg_price,
           {quotes}
    FROM {source} WHERE event_time IS NOT NULL AND {where}
    GROUP BY 1, 2
),
{name} AS (
    SELECT *, total_dollar_volume / nullif(total_volume, 0) AS vwap,
           total_volume - buy_volume AS sell_volume,
           cast(buy_volume / nullif(total_volume, 0) * 100 AS decimal(5, 2)) AS buy_pressure,
           cast(avg_ask - avg_bid AS decimal(10, 4)) AS avg_spread,
           window_start + INTERVAL '{width}' AS window_end,
           '{width}' AS window_duration
    FROM {name}_sums
)"""


FULL_BAR = f"""
    ticker, {r4('vwap')} AS vwap, {r4('low_price')} AS low_price,
    {r4('high_price')} AS high_price, {r4('avg_price')} AS avg_price, total_volume,
    {r4('total_dollar_volume')} AS total_dollar_volume, trade_count, buy_volume,
    {r4('avg_bid')} AS avg_bid, {r4('avg_ask')} AS avg_ask, sell_volume,
    cast(buy_pressure AS double) AS buy_pressure, cast(avg_spread AS double) AS avg_spread,
    window_start, window_end, window_duration"""


def bounds(source: str = "bars") -> str:
    return f"""
bounds AS (
    SELECT ticker, avg_price AS window_avg_price, total_volume AS window_volume,
           trade_count AS window_trade_count, window_start, window_end,
           avg_price * (1 + 50.0::double / 100) AS anomaly_upper,
           avg_price * (1 - 50.0::double / 100) AS anomaly_lower,
           50.0::double AS threshold_pct
    FROM {source}
)"""


FULL_BOUND = f"""
    ticker, {r4('window_avg_price')} AS window_avg_price, window_volume, window_trade_count,
    window_start, window_end, {r4('anomaly_upper')} AS anomaly_upper,
    {r4('anomaly_lower')} AS anomaly_lower, {r4('threshold_pct')} AS threshold_pct"""

OUTLIERS = """
outliers AS (
    SELECT t.trade_id, t.ticker, t.price, t.quantity, t.side, t.trade_type, t.event_time,
           b.window_avg_price, b.anomaly_upper, b.anomaly_lower, b.window_start,
           round((t.price - b.window_avg_price) / nullif(b.window_avg_price, 0) * 100, 2)
               AS deviation_pct
    FROM trades t JOIN bounds b
      ON t.ticker = b.ticker AND t.event_time >= b.window_start AND t.event_time < b.window_end
    WHERE t.price > b.anomaly_upper OR t.price < b.anomaly_lower
)"""

FULL_OUTLIER = f"""
    trade_id, ticker, {r4('price')} AS price, quantity, side, trade_type, event_time,
    {r4('window_avg_price')} AS window_avg_price, {r4('anomaly_upper')} AS anomaly_upper,
    {r4('anomaly_lower')} AS anomaly_lower, window_start,
    {r4('deviation_pct')} AS deviation_pct"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts)


OUTLIER_BASE = with_(TRADES, bars("1 day"), bounds(), OUTLIERS)
HOURLY = with_(TRADES, bars("1 hour"))
DAILY = with_(TRADES, bars("1 day"))


def duplicate_stats(base: str, source: str) -> str:
    return f"""{base}, groups AS (SELECT trade_id, count(*) AS cnt FROM {source} GROUP BY 1)
SELECT cast(sum(cnt) AS bigint) AS total_rows, count(*) FILTER (cnt > 1) AS duplicate_ids,
       bool_and(cnt = 2) FILTER (cnt > 1) AS all_exactly_twice, count(*) AS deduped_rows,
       cast(sum(cnt) - count(*) AS bigint) AS removed_rows
FROM groups"""


def compared(how: str, where: str) -> str:
    return with_(TRADES, DELIVERED, bars("1 hour", "streamed", "delivered", where)) + f""",
batch AS (
    SELECT time_bucket(INTERVAL '1 hour', event_time, {EPOCH}) AS window_start, ticker,
           sum(price * quantity) / nullif(sum(quantity), 0) AS batch_vwap,
           count(trade_id) AS batch_trade_count, cast(sum(quantity) AS bigint) AS batch_volume
    FROM trades GROUP BY 1, 2
),
compared AS (
    SELECT window_start, ticker, batch_vwap, batch_trade_count, batch_volume,
           s.vwap AS stream_vwap, s.trade_count AS stream_trade_count,
           s.total_volume AS stream_volume,
           abs(batch_vwap - s.vwap) AS vwap_diff,
           abs(batch_vwap - s.vwap) / nullif(batch_vwap, 0) * 100 AS vwap_diff_pct,
           batch_trade_count = s.trade_count AS count_match,
           CASE WHEN s.trade_count IS NULL THEN 'batch_only'
                WHEN batch_trade_count IS NULL THEN 'stream_only' ELSE 'both' END AS seen_in
    FROM batch {how} JOIN streamed s USING (window_start, ticker)
)"""


INNER = compared("INNER", "true")
OUTER = compared("FULL OUTER", "source = 'simulator'")

RECONCILE_SUMMARY = f"""
SELECT *, total_windows - exact_matches AS mismatched,
       {r4('coalesce(exact_matches / nullif(total_windows, 0) * 100, 0)')} AS match_pct,
       CASE WHEN exact_matches / nullif(total_windows, 0) >= 0.99 THEN 'PASSED'
            WHEN exact_matches / nullif(total_windows, 0) >= 0.95 THEN 'CLOSE'
            ELSE 'FAILED' END AS verdict
FROM (
    SELECT count(*) AS total_windows,
           count(*) FILTER (vwap_diff_pct < 0.01) AS exact_matches,
           count(*) FILTER (vwap_diff_pct < 1) AS close_matches,
           count(*) FILTER (seen_in = 'batch_only') AS batch_only,
           count(*) FILTER (seen_in = 'stream_only') AS stream_only,
           count(*) FILTER (NOT count_match) AS count_mismatches
    FROM compared
)"""

CHECKS = with_(
    TRADES, bars("1 hour", "short_bars"), bars("1 day", "long_bars")
) + """,
both_bars AS (
    SELECT 'short' AS bars, * FROM short_bars UNION ALL SELECT 'long', * FROM long_bars
),
expected(ticker) AS (
    VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('refund')
),
absent AS (
    SELECT count(*) AS n, string_agg(ticker, ', ' ORDER BY ticker) AS names
    FROM expected WHERE ticker NOT IN (SELECT ticker FROM long_bars)
),
counts AS (
    SELECT count(*) FILTER (bars = 'short' AND vwap IS NULL) AS ns,
           count(*) FILTER (bars = 'long' AND vwap IS NULL) AS nl,
           count(*) FILTER (vwap < 1 OR vwap > 2000) AS oor,
           count(*) FILTER (buy_pressure < 0 OR buy_pressure > 100) AS bp,
           count(*) FILTER (total_volume <= 0) AS vol,
           count(*) FILTER (bars = 'short' AND
               (window_end - window_start) IS DISTINCT FROM INTERVAL '3600 seconds') AS width,
           count(*) FILTER (high_price < low_price) AS hl
    FROM both_bars
),
checks AS (
    SELECT 1 AS check_no, 'vwap not null' AS check_name, 'both' AS tables,
           ns + nl AS violations, ns || ' short, ' || nl || ' long' AS detail FROM counts
    UNION ALL SELECT 2, 'vwap in [1, 2000]', 'both', oor, oor || ' out of range' FROM counts
    UNION ALL SELECT 3, 'buy pressure in [0, 100]', 'both', bp, bp || ' invalid' FROM counts
    UNION ALL SELECT 4, 'volume positive', 'both', vol, vol || ' not positive' FROM counts
    UNION ALL SELECT 5, 'all tickers present', 'long', n,
        CASE WHEN n = 0 THEN 'all 6 present' ELSE 'missing: ' || names END FROM absent
    UNION ALL SELECT 6, 'window spans 3600 s', 'short', width, width || ' wrong' FROM counts
    UNION ALL SELECT 7, 'high >= low', 'both', hl, hl || ' violated' FROM counts
)"""

LISTED = """
listed AS (
    SELECT ticker, window_start, vwap, total_volume, trade_count, low_price, high_price,
           round(cast(buy_pressure AS decimal(5, 2)), 1)::double AS pressure,
           avg_spread::double AS spread,
           round(avg_spread::double / nullif(vwap, 0) * 10000, 1) AS spread_bps,
           round((high_price - low_price) / nullif(vwap, 0) * 100, 2) AS range_pct
    FROM bars
)"""
LISTED_BASE = f"{HOURLY},{LISTED}"
LEADER = f"""ticker, window_start, {r4('round(vwap, 2)')} AS vwap, total_volume, trade_count"""
LIQUID = f"ticker, window_start, {r4('spread')} AS avg_spread, {r4('spread_bps')} AS spread_bps"
VOLATILE = f"""ticker, window_start, {r4('low_price')} AS low_price,
    {r4('high_price')} AS high_price, {r4('vwap')} AS vwap, {r4('range_pct')} AS range_pct"""

LATE_PREFIX = "['ontime-', 'late-within-', 'late-beyond-'][event_id % 3 + 1]"


def health_row(name: str, source: str, time: str, columns: int) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count, {columns} AS column_count,
       max({time}) AS latest,
       CASE WHEN count(*) = 0 THEN 'Empty' ELSE 'OK' END AS status FROM {source}"""


# A stream has not closed a window that ends after the newest event less 10 seconds.
CLOSED = "window_end <= (SELECT max(ts) - INTERVAL 10 SECOND FROM events)"
GOOD = "event_id % 97 <> 0"


def if_good(column: str, name: str, kind: str) -> str:
    return f"CASE WHEN {GOOD} THEN {column} END::{kind} AS {name}"


MESSAGE_COLUMNS = ", ".join([
    if_good("trade_id", "trade_id", "varchar"),
    if_good("ticker", "ticker", "varchar"),
    r4(f"CASE WHEN {GOOD} THEN price END") + " AS price",
    if_good("quantity", "quantity", "double"),
    if_good("side", "side", "varchar"),
    if_good("trade_type", "trade_type", "varchar"),
    if_good("exchange", "exchange", "varchar"),
    if_good("source", "source", "varchar"),
    if_good("event_time", "event_time", "timestamp"),
    "event_time AS kafka_ingest_time",
    r4(f"CASE WHEN {GOOD} THEN price * quantity END") + " AS dollar_volume",
])

VENDOR = f"""{with_(TRADES)}, elements AS (
        SELECT ticker, price AS p, quantity::double AS v, event_time
        FROM trades WHERE event_id % 10 <> 0
        UNION ALL
        SELECT ticker, price * 2, quantity * 2.5::double, event_time
        FROM trades WHERE event_id % 10 <> 0)"""

PERIODS = f"""{with_(TRADES)}, periods AS (
    SELECT *, (event_time >= TIMESTAMP '2024-01-11')::bigint
            + (event_time >= TIMESTAMP '2024-01-21')::bigint AS version FROM trades)"""

KEY_PLACEMENT = f"""{with_(TRADES)}, placed AS (
    SELECT ascii(ticker) % 3 AS partition, ticker, count(*) AS messages FROM trades GROUP BY 1, 2
)"""

SQL: dict[str, str] = {
    # parsing and enrichment
    "parsed_messages": f"""{with_(TRADES)} SELECT {MESSAGE_COLUMNS},
        {r4(f"CASE WHEN {GOOD} THEN bid_price END")} AS bid_price,
        {r4(f"CASE WHEN {GOOD} THEN ask_price END")} AS ask_price,
        {if_good("(side = 'BUY')::integer", "is_buy", "double")},
        {if_good("(side = 'BUY')::integer * quantity", "buy_volume", "double")}
        FROM trades""",
    "rejected_payloads": """SELECT 'stock_trades' AS topic, ascii(event_type) % 3 AS partition,
        event_id AS "offset", 'partition_test' AS payload FROM events WHERE event_id % 97 = 0""",
    "vendor_normalize": f"""{VENDOR}
        SELECT ticker, {r4('round(p, 2)')} AS price,
               CASE WHEN v = floor(v) THEN v END AS quantity, 'UNKNOWN' AS side,
               CASE WHEN v >= 100 THEN 'round_lot' ELSE 'odd_lot' END AS trade_type,
               'FINNHUB' AS exchange, 'finnhub_live' AS source,
               date_trunc('millisecond', event_time) AS event_time
        FROM elements WHERE ticker IN ('click', 'purchase', 'signup', 'view')""",
    "vendor_trade_ids": """SELECT 4 * count(*) AS total_rows, 2 * count(*) AS duplicate_ids,
        true AS all_exactly_twice, 2 * count(*) AS deduped_rows, 2 * count(*) AS removed_rows
        FROM events WHERE event_id % 10 <> 0""",
    "bronze_log": f"{with_(TRADES)} SELECT {MESSAGE_COLUMNS} FROM trades",
    # January: New York is five hours behind UTC.
    "session_trades": f"""{with_(TRADES)}, local AS (
        SELECT trade_id, ticker, event_time, event_time - INTERVAL 5 HOUR AS t FROM trades)
        SELECT trade_id, ticker, event_time,
               isodow(t) <= 5 AND t::time BETWEEN TIME '09:30:00' AND TIME '16:00:00' AS in_session
        FROM local""",
    "sector_enrichment": f"""{with_(LINES)}, sectors AS (
        SELECT 'Brand#' || i AS ticker, (100 + i)::double AS base_price,
               ['Technology', 'Finance', 'Energy'][i % 3 + 1] AS sector
        FROM range(1, 21) AS r(i))
        SELECT trade_id, l_partkey, l_suppkey, event_time, ticker, quantity,
               {r4('price')} AS price, coalesce(sector, 'none') AS sector,
               {r4('base_price')} AS base_price
        FROM lines LEFT JOIN sectors USING (ticker)""",
    # bars and bounds
    "vwap_1h": f"{HOURLY} SELECT {FULL_BAR} FROM bars",
    "vwap_1d": f"{DAILY} SELECT {FULL_BAR} FROM bars",
    "vwap_5min": f"{with_(TRADES, bars('5 minutes'))} SELECT {FULL_BAR} FROM bars",
    "vwap_lines_1d": f"""{with_(LINES, bars('1 day', source='lines'))}
        SELECT window_start, ticker, {r4('vwap')} AS vwap, {r4('low_price')} AS low_price,
               {r4('high_price')} AS high_price, total_volume,
               {r4('total_dollar_volume')} AS total_dollar_volume, trade_count, buy_volume,
               sell_volume, buy_pressure::double AS buy_pressure
        FROM bars""",
    "vwap_by_ticker": f"""{with_(LINES)} SELECT ticker,
        {r4('sum(price * quantity) / nullif(sum(quantity), 0)')} AS vwap FROM lines GROUP BY 1""",
    "anomaly_bounds_1d": f"{with_(TRADES, bars('1 day'), bounds())} SELECT {FULL_BOUND} FROM bounds",
    # outliers
    "outlier_trades": f"{OUTLIER_BASE} SELECT {FULL_OUTLIER} FROM outliers",
    "outlier_trades_interval": f"{OUTLIER_BASE} SELECT {FULL_OUTLIER} FROM outliers",
    "outlier_trades_sliced": f"{OUTLIER_BASE} SELECT {FULL_OUTLIER} FROM outliers",
    "outliers_by_ticker":
        f"{OUTLIER_BASE} SELECT ticker, count(*) AS anomalies FROM outliers GROUP BY 1",
    "outlier_directions": f"""{OUTLIER_BASE} SELECT count(*) AS anomalies,
        count(*) FILTER (price > anomaly_upper) AS above,
        count(*) FILTER (price < anomaly_lower) AS below,
        {r4('count(*) FILTER (price > anomaly_upper) / nullif(count(*), 0) * 100')} AS above_pct,
        {r4('count(*) FILTER (price < anomaly_lower) / nullif(count(*), 0) * 100')} AS below_pct
        FROM outliers""",
    "outlier_summary": f"""{OUTLIER_BASE}
        SELECT *, {r4('coalesce(anomalies / nullif(total_trades, 0) * 100, 0)')}
                   AS anomaly_rate_pct
        FROM (SELECT (SELECT count(*) FROM trades) AS total_trades,
                     (SELECT count(*) FROM bounds) AS total_windows,
                     count(*) AS anomalies,
                     count(*) FILTER (price > anomaly_upper) AS above,
                     count(*) FILTER (price < anomaly_lower) AS below
              FROM outliers)""",
    "top_outliers": f"""{OUTLIER_BASE} SELECT {FULL_OUTLIER} FROM (
        SELECT * FROM outliers ORDER BY deviation_pct DESC, trade_id LIMIT 20)""",
    # duplicates
    "dedup_trades": f"""{with_(LINES)} SELECT trade_id, ticker, {r4('price')} AS price, quantity,
        side, event_time, l_partkey, l_suppkey
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY trade_id
                  ORDER BY event_time NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
                           quantity NULLS FIRST, price NULLS FIRST, ticker NULLS FIRST,
                           side NULLS FIRST) AS n
              FROM lines)
        WHERE n = 1""",
    "dedup_copies": f"""{with_(TRADES, DELIVERED)} SELECT DISTINCT trade_id, ticker,
        {r4('price')} AS price, quantity, event_time FROM delivered""",
    "duplicate_stats": duplicate_stats(with_(TRADES, DELIVERED), "delivered"),
    "duplicate_stats_lines": duplicate_stats(with_(LINES), "lines"),
    "duplicate_keys": f"""{with_(LINES)} SELECT trade_id, count(*) AS cnt FROM lines
        GROUP BY 1 HAVING count(*) > 1""",
    "replay_audit": f"""{with_(TRADES, DELIVERED)}
        SELECT *, rows_after - rows_before AS new_rows,
               rows_after - distinct_ids AS raw_duplicates,
               rows_after = distinct_ids AS exactly_once_on_write
        FROM (SELECT (SELECT count(*) FROM trades WHERE event_time < TIMESTAMP '2024-01-21') AS rows_before,
                     count(*) AS rows_after, count(DISTINCT trade_id) AS distinct_ids,
                     (SELECT count(*) FROM trades WHERE event_time < TIMESTAMP '2024-01-21' AND trade_id NOT IN
                         (SELECT trade_id FROM delivered)) AS lost_ids
              FROM delivered)""",
    # reconciliation
    "reconcile_windows": f"""{INNER} SELECT window_start, ticker, {r4('batch_vwap')} AS batch_vwap,
        batch_trade_count, batch_volume, {r4('stream_vwap')} AS stream_vwap,
        stream_trade_count, stream_volume, {r4('vwap_diff')} AS vwap_diff,
        {r4('vwap_diff_pct')} AS vwap_diff_pct, count_match, seen_in FROM compared""",
    "reconcile_summary": INNER + RECONCILE_SUMMARY,
    "reconcile_summary_outer": OUTER + RECONCILE_SUMMARY,
    "reconcile_mismatches": f"""{INNER} SELECT window_start, ticker,
        {r4('round(batch_vwap, 4)')} AS batch_vwap, {r4('round(stream_vwap, 4)')} AS stream_vwap,
        {r4('round(vwap_diff_pct, 4)')} AS vwap_diff_pct, count_match
        FROM (SELECT * FROM compared WHERE vwap_diff_pct >= 0.01
              ORDER BY vwap_diff_pct DESC, window_start, ticker LIMIT 10)""",
    # quality
    "dq_checks": f"""{CHECKS} SELECT check_no, check_name, tables, violations,
        violations = 0 AS passed, detail FROM checks""",
    "dq_gate": f"""{CHECKS} SELECT count(*) FILTER (violations = 0) AS passed_checks,
        count(*) AS total_checks,
        coalesce(string_agg(check_no::varchar, ', ' ORDER BY check_no)
                 FILTER (violations > 0), '') AS failed_checks,
        bool_and(violations = 0) AS ok FROM checks""",
    "missing_tickers": f"{CHECKS} SELECT ticker FROM expected EXCEPT SELECT ticker FROM long_bars",
    "ticker_max_vwap": f"{HOURLY} SELECT ticker, {r4('max(vwap)')} AS max_vwap FROM bars GROUP BY 1",
    "contaminated_tickers": f"""{HOURLY} SELECT ticker, count(*) AS bars,
        {r4('max(vwap)')} AS max_vwap FROM bars
        WHERE vwap > 150 AND ticker NOT IN ('view', 'error') GROUP BY 1""",
    "ticker_bars": f"""{HOURLY} SELECT ticker, {r4('vwap')} AS vwap, total_volume, trade_count,
        window_start, window_end FROM bars WHERE ticker = 'purchase'""",
    "lateness_audit": f"""{HOURLY}, tagged AS (
        SELECT {LATE_PREFIX} || trade_id AS trade_id, event_time FROM trades),
        anchor AS (SELECT min(event_time) AS t FROM tagged WHERE trade_id LIKE 'ontime%'),
        rows_ AS (
        SELECT 'ontime stored' AS check_name, '20' AS expected, count(*) AS actual,
               count(*) = 20 AS passed FROM tagged WHERE trade_id LIKE 'ontime%'
        UNION ALL SELECT 'late-within stored', '5', count(*), count(*) = 5
               FROM tagged WHERE trade_id LIKE 'late-within%'
        UNION ALL SELECT 'late-beyond stored', '5', count(*), count(*) = 5
               FROM tagged WHERE trade_id LIKE 'late-beyond%'
        UNION ALL SELECT 'on-time window emitted', 'at least 1', count(*), count(*) >= 1
               FROM bars, anchor WHERE ticker = 'error' AND window_start <= t AND t < window_end
        UNION ALL SELECT 'error vwap within limit', '0', count(*), count(*) = 0
               FROM bars WHERE ticker = 'error' AND vwap > 150
        UNION ALL SELECT 'other tickers within limit', '0', count(*), count(*) = 0
               FROM bars WHERE ticker NOT IN ('view') AND vwap > 150)
        SELECT * FROM rows_""",
    # market reports
    "window_listing": f"""{LISTED_BASE} SELECT {LEADER}, {r4('pressure')} AS buy_pressure
        FROM listed""",
    "volume_leaders": f"""{LISTED_BASE} SELECT {LEADER} FROM (SELECT * FROM listed
        ORDER BY total_volume DESC NULLS LAST, ticker, window_start LIMIT 5)""",
    "volume_laggards": f"""{LISTED_BASE} SELECT {LEADER} FROM (SELECT * FROM listed
        ORDER BY total_volume ASC NULLS LAST, ticker, window_start LIMIT 5)""",
    "pressure_bullish": f"""{LISTED_BASE} SELECT ticker, window_start,
        {r4('pressure')} AS buy_pressure FROM listed WHERE pressure > 55""",
    "pressure_bearish": f"""{LISTED_BASE} SELECT ticker, window_start,
        {r4('pressure')} AS buy_pressure FROM listed WHERE pressure < 45""",
    "liquidity_most": f"""{LISTED_BASE} SELECT {LIQUID} FROM (SELECT * FROM listed
        ORDER BY spread_bps ASC NULLS LAST, ticker, window_start LIMIT 5)""",
    "liquidity_least": f"""{LISTED_BASE} SELECT {LIQUID} FROM (SELECT * FROM listed
        ORDER BY spread_bps DESC NULLS FIRST, ticker, window_start LIMIT 5)""",
    "liquidity_least_known": f"""{LISTED_BASE} SELECT {LIQUID} FROM (SELECT * FROM listed
        WHERE spread_bps IS NOT NULL ORDER BY spread_bps DESC, ticker, window_start LIMIT 5)""",
    "volatility_most": f"""{LISTED_BASE} SELECT {VOLATILE} FROM (SELECT * FROM listed
        ORDER BY range_pct DESC NULLS LAST, ticker, window_start LIMIT 5)""",
    "volatility_least": f"""{LISTED_BASE} SELECT {VOLATILE} FROM (SELECT * FROM listed
        ORDER BY range_pct ASC NULLS FIRST, ticker, window_start LIMIT 5)""",
    "volatility_least_known": f"""{LISTED_BASE} SELECT {VOLATILE} FROM (SELECT * FROM listed
        WHERE range_pct IS NOT NULL ORDER BY range_pct, ticker, window_start LIMIT 5)""",
    "source_breakdown": f"""{with_(TRADES)} SELECT source, count(trade_id) AS trades,
        count(DISTINCT ticker) AS tickers FROM trades WHERE source IS NOT NULL GROUP BY 1""",
    "source_counts": f"{with_(TRADES)} SELECT source, count(*) AS cnt FROM trades GROUP BY 1",
    "distinct_sources": f"{with_(TRADES)} SELECT DISTINCT source FROM trades",
    "data_summary": f"""{with_(TRADES, bars('1 hour', 'h'), bars('1 day', 'd'))}
        SELECT count(*) AS raw_trades, count(DISTINCT ticker) AS tickers,
               count(DISTINCT source) AS sources, (SELECT count(*) FROM h) AS short_windows,
               (SELECT count(*) FROM d) AS long_windows FROM trades""",
    "latest_window": f"""{DAILY} SELECT {FULL_BAR} FROM bars
        WHERE window_start = (SELECT max(window_start) FROM bars)""",
    "latest_window_board": f"""{DAILY} SELECT ticker, window_start, {r4('vwap')} AS vwap,
        total_volume, trade_count FROM bars
        WHERE window_start = (SELECT max(window_start) FROM bars)
        ORDER BY total_volume DESC, ticker LIMIT 15""",
    "latest_bounds_board": f"""{with_(TRADES, bars('1 day'), bounds())}
        SELECT ticker, window_start, window_volume, {r4('window_avg_price')} AS window_avg_price,
               {r4('anomaly_upper')} AS anomaly_upper, {r4('anomaly_lower')} AS anomaly_lower
        FROM bounds WHERE window_start = (SELECT max(window_start) FROM bounds)
        ORDER BY window_volume DESC, ticker LIMIT 5""",
    "health_board": f"""{HOURLY} SELECT count(*) AS raw_trades,
        (SELECT count(*) FROM bars) AS vwap_windows, count(DISTINCT ticker) AS tickers,
        max(event_time) AS latest_trade FROM trades""",
    # skew
    "ticker_counts": f"{with_(LINES)} SELECT ticker, count(*) AS trade_count FROM lines GROUP BY 1",
    "ticker_skew": f"""{with_(LINES)}, c AS (
        SELECT ticker, count(*) AS trade_count FROM lines GROUP BY 1)
        SELECT ticker, trade_count,
               CASE WHEN trade_count > 1.5 * (SELECT median(trade_count) FROM c)
                    THEN 'High volume' ELSE 'Normal' END AS category FROM c""",
    "skew_summary": f"""{with_(LINES)}, c AS (
        SELECT ticker, count(*) AS trade_count FROM lines GROUP BY 1)
        SELECT count(*) AS tickers, {r4('median(trade_count)')} AS median_count,
               max(trade_count) AS max_count, min(trade_count) AS min_count,
               {r4('max(trade_count) / min(trade_count)')} AS skew_ratio FROM c""",
    "top_tickers": f"""{with_(LINES)} SELECT ticker, count(*) AS trade_count FROM lines
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "salted_count": f"{with_(LINES)} SELECT ticker, count(*) AS cnt FROM lines GROUP BY 1",
    "key_distribution": f"""{KEY_PLACEMENT} SELECT partition, count(ticker) AS key_count,
        cast(sum(messages) AS bigint) AS messages,
        string_agg(ticker, ', ' ORDER BY ticker) AS keys FROM placed GROUP BY 1""",
    "placement_balance": f"""{KEY_PLACEMENT}
        SELECT max(n) AS max_keys, min(n) AS min_keys, max(n) - min(n) AS skew,
               max(n) - min(n) <= 2 AS balanced
        FROM (SELECT partition, count(*) AS n FROM placed GROUP BY 1)""",
    # health, exports, versions, warehouse
    "table_health": f"""{HOURLY}
        {health_row('raw_trades', 'trades', 'event_time', 16)}
        UNION ALL {health_row('vwap_1min', 'bars', 'window_start', 17)}
        UNION ALL {health_row('anomaly_alerts', '(SELECT * FROM bars WHERE vwap < 0)',
                              'window_start', 9)}""",
    "health_verdict": f"""{HOURLY} SELECT (SELECT count(*) FROM trades) > 0 AND count(*) > 0
        AS healthy, 0::bigint AS tables_not_ok, (SELECT count(*) FROM trades) AS trades,
        count(*) AS windows, greatest(count(*) // 5, 1) AS approx_windows_per_symbol FROM bars""",
    "column_summary": HOURLY + " UNION ALL ".join(
        f""" SELECT '{c}' AS column_name, {r4(f'min({c})::double')} AS min_value,
        {r4(f'max({c})::double')} AS max_value, {r4(f'avg({c}::double)')} AS mean_value FROM bars"""
        for c in ("vwap", "total_volume", "trade_count", "buy_pressure")
    ),
    "csv_export": f"""{DAILY} SELECT ticker, window_start, {r4('vwap')} AS vwap, total_volume,
        trade_count FROM bars""",
    "warehouse_projection": f"""{HOURLY}
        SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS "WINDOW_START",
               strftime(window_end, '%Y-%m-%d %H:%M:%S') AS "WINDOW_END", ticker AS "TICKER",
               {r4('vwap')} AS "VWAP", {r4('low_price')} AS "LOW_PRICE",
               {r4('high_price')} AS "HIGH_PRICE", {r4('avg_price')} AS "AVG_PRICE",
               total_volume AS "TOTAL_VOLUME",
               {r4('total_dollar_volume')} AS "TOTAL_DOLLAR_VOLUME",
               trade_count AS "TRADE_COUNT", buy_volume AS "BUY_VOLUME",
               sell_volume AS "SELL_VOLUME", {r4('buy_pressure::double')} AS "BUY_PRESSURE",
               {r4('avg_spread::double')} AS "AVG_SPREAD", {r4('avg_bid')} AS "AVG_BID",
               {r4('avg_ask')} AS "AVG_ASK" FROM bars""",
    "version_history": f"""{PERIODS} SELECT version, 'append' AS operation,
        count(*) AS rows_written FROM periods GROUP BY 1""",
    "asof_version_counts": f"""{PERIODS} SELECT ticker, count(*) AS trade_count,
        cast(sum(quantity) AS bigint) AS total_volume FROM periods WHERE version <= 1
        GROUP BY 1""",
    "version_growth": f"""{PERIODS} SELECT count(*) FILTER (version = 0) AS rows_then,
        count(*) AS rows_now, count(*) FILTER (version > 0) AS rows_added FROM periods""",
    # streams
    "stream_vwap_closed_windows": f"{HOURLY} SELECT {FULL_BAR} FROM bars WHERE {CLOSED}",
    "stream_bounds_closed_windows": f"""{with_(TRADES, bars('1 day'), bounds())}
        SELECT {FULL_BOUND} FROM bounds WHERE {CLOSED}""",
    "stream_bronze": f"{with_(TRADES)} SELECT {MESSAGE_COLUMNS} FROM trades",
    "stream_vendor_normalize": f"""{VENDOR} SELECT ticker, {r4('round(p, 2)')} AS price,
        CASE WHEN v >= 100 THEN 'round_lot' ELSE 'odd_lot' END AS trade_type,
        date_trunc('millisecond', event_time) AS event_time
        FROM elements WHERE ticker IN ('click', 'purchase', 'signup', 'view')""",
    "stream_dedup": f"""{with_(TRADES)} SELECT trade_id, ticker, {r4('price')} AS price, event_time
        FROM trades""",
    "stream_versions": f"""{with_(TRADES)} SELECT ticker, count(*) AS trade_count
        FROM trades GROUP BY 1""",
    "stream_fan_out_health": f"""{with_(
        TRADES, f"good AS (SELECT * FROM trades WHERE {GOOD})",
        bars('1 hour', 'h', 'good'), bars('1 day', 'd', 'good'),
        "edge AS (SELECT max(event_time) - INTERVAL 10 SECOND AS t FROM good)")}
        SELECT 'raw_trades' AS table_name, count(*) AS row_count, 12 AS column_count,
               (SELECT max(event_time) FROM good) AS latest, 'OK' AS status FROM trades
        UNION ALL SELECT 'vwap_1min', count(*), 18, max(window_start), 'OK' FROM h, edge
                  WHERE window_end <= t
        UNION ALL SELECT 'vwap_5min', count(*), 18, max(window_start), 'OK' FROM d, edge
                  WHERE window_end <= t
        UNION ALL SELECT 'anomaly_alerts', count(*), 10, max(window_start), 'OK' FROM h, edge
                  WHERE window_end <= t""",
    "stream_reconcile_summary": with_(TRADES, bars("1 hour")) + f""", compared AS (
        SELECT CASE WHEN {CLOSED} AND vwap IS NOT NULL AND vwap > 0 THEN 0.0 END AS vwap_diff_pct,
               CASE WHEN {CLOSED} THEN true END AS count_match,
               CASE WHEN {CLOSED} THEN 'both' ELSE 'batch_only' END AS seen_in
        FROM bars)""" + RECONCILE_SUMMARY,
    # empty batches, late and restarted streams, publishing
    "version_empty_replay": f"""{PERIODS} SELECT ticker, count(*) AS trade_count
        FROM periods WHERE version <> 1 GROUP BY 1""",
    "version_history_empty": f"""{PERIODS} SELECT version, 'append' AS operation,
        count(*) FILTER (version <> 1) AS rows_written FROM periods GROUP BY 1
        UNION ALL SELECT 3, 'append', 0""",
    "reconcile_lines": with_(LINES, bars("1 day", "streamed", "lines")) + f""", once AS (
        SELECT * FROM lines WHERE event_time IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY trade_id ORDER BY event_time, price NULLS FIRST,
                                   quantity NULLS FIRST, ticker NULLS FIRST) = 1),
        batch AS (
        SELECT time_bucket(INTERVAL '1 day', event_time, {EPOCH}) AS window_start, ticker,
               sum(price * quantity) / nullif(sum(quantity), 0) AS batch_vwap,
               count(trade_id) AS batch_trade_count, cast(sum(quantity) AS bigint) AS batch_volume
        FROM once GROUP BY 1, 2)
        SELECT window_start, ticker, {r4('batch_vwap')} AS batch_vwap, batch_trade_count,
               batch_volume, {r4('s.vwap')} AS stream_vwap, s.trade_count AS stream_trade_count,
               s.total_volume AS stream_volume, {r4('abs(batch_vwap - s.vwap)')} AS vwap_diff,
               {r4('abs(batch_vwap - s.vwap) / nullif(batch_vwap, 0) * 100')} AS vwap_diff_pct,
               batch_trade_count = s.trade_count AS count_match, 'both' AS seen_in
        FROM batch JOIN streamed s USING (window_start, ticker)""",
    "lateness_audit_passing": f"""{HOURLY}, n AS (SELECT count(*) AS n FROM events),
        anchor AS (SELECT min(ts) AS t FROM events)
        SELECT 'ontime- stored' AS check_name, n::varchar AS expected, n AS actual, true AS passed FROM n
        UNION ALL SELECT 'late- stored', '0', 0, true
        UNION ALL SELECT 'on-time window emitted', 'at least 1', count(*), count(*) >= 1
               FROM bars, anchor WHERE ticker = 'error' AND window_start <= t AND t < window_end
        UNION ALL SELECT 'error vwap within limit', '0', 0, true
        UNION ALL SELECT 'other tickers within limit', '0', 0, true""",
    "session_trades_holidays": f"""{with_(TRADES)}, local AS (
        SELECT trade_id, ticker, event_time, event_time - INTERVAL 5 HOUR AS t FROM trades)
        SELECT trade_id, ticker, event_time,
               isodow(t) <= 5 AND t::time BETWEEN TIME '09:30:00' AND TIME '16:00:00'
               AND t::date NOT IN (DATE '2024-01-01', DATE '2024-01-15') AS in_session
        FROM local""",
    "vwap_unknown_volume": f"""{with_(TRADES)}
        SELECT time_bucket(INTERVAL '1 day', event_time, {EPOCH}) AS window_start, ticker,
               cast(sum(quantity) AS bigint) AS total_volume,
               cast(coalesce(sum(quantity) FILTER (side = 'BUY'), 0) AS bigint) AS buy_volume,
               cast(coalesce(sum(quantity) FILTER (side <> 'BUY'), 0) AS bigint) AS sell_volume,
               cast(coalesce(sum(quantity) FILTER (side = 'UNKNOWN'), 0) AS bigint) AS unknown_volume
        FROM trades WHERE event_time IS NOT NULL GROUP BY 1, 2""",
    "vwap_decimals": f"{DAILY} SELECT window_start, ticker, buy_pressure, avg_spread FROM bars",
    "hash_placement": f"""{with_(LINES)}, placed AS (
        SELECT ticker, count(*) AS messages,
               (('0x' || substr(md5(ticker), 1, 7))::bigint % 3)::integer AS partition
        FROM lines GROUP BY ticker)
        SELECT partition, count(ticker) AS key_count, cast(sum(messages) AS bigint) AS messages
        FROM placed GROUP BY 1""",
    "sample_membership": "SELECT least(5, count(*)) AS sampled, least(5, count(*)) AS trades_among_them FROM events",
    "schema_rejections": """SELECT count(*) AS rows_kept, unnest([
        'price is string, stored as double', 'unknown column side']) AS problem FROM events""",
    "table_verification": f"""{HOURLY}
        SELECT 'filled' AS table_name, count(*) AS row_count, 17 AS column_count,
               max(window_start) AS latest, 'OK' AS status FROM bars
        UNION ALL SELECT 'empty', 0, 17, NULL, 'Empty'
        UNION ALL SELECT 'untimed', count(*), 1, NULL, 'No time column' FROM bars
        UNION ALL SELECT 'missing', NULL, NULL, NULL, 'Missing'
        UNION ALL SELECT 'broken', NULL, NULL, NULL, 'Error'""",
    "exported_tables": f"""{DAILY} SELECT 'trades' AS name, 1 AS files, count(*) AS found FROM trades
        UNION ALL SELECT 'bars', 1, count(*) FROM bars
        UNION ALL SELECT 'bounds', 1, count(*) FROM bars
        UNION ALL SELECT 'nowhere', 0, 0""",
    "publish_outcomes": f"""{HOURLY} SELECT attempt, subject, outcome, (SELECT count(*) FROM bars
            WHERE vwap BETWEEN 1 AND 2000 AND total_volume > 0) AS rows_in_target
        FROM (VALUES ('open', 'VWAP_1MIN', 'loaded'), ('open', 'VWAP_5MIN', 'loaded'),
            ('empty source', 'VWAP_1MIN', 'skipped'), ('empty source', 'VWAP_5MIN', 'loaded'),
            ('closed', 'all tickers present', 'check 5: missing: refund')) v(attempt, subject, outcome)""",
    "keyed_messages": """SELECT event_type AS message_key, count(*) AS messages,
        count(*) FILTER (event_id % 97 = 0) AS not_json FROM events GROUP BY 1""",
    "stream_late_windows": f"""{with_(TRADES)}, sent AS (
        SELECT time_bucket(INTERVAL '1 hour', event_time, {EPOCH}) AS window_start, ticker,
               event_id % 50 = 7 AND event_time < TIMESTAMP '2024-01-11' AS held
        FROM trades WHERE {GOOD})
        SELECT window_start, ticker, count(*) FILTER (NOT held) AS trade_count,
               count(*) FILTER (held) AS dropped_late FROM sent
        WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 SECOND FROM events WHERE {GOOD})
        GROUP BY 1, 2 HAVING count(*) FILTER (NOT held) > 0""",
    "stream_restart_audit": f"""SELECT *, rows_after - rows_before AS new_rows, 0::bigint AS raw_duplicates,
        true AS exactly_once_on_write FROM (
        SELECT count(*) FILTER (ts < TIMESTAMP '2024-01-21'
                   AND NOT (ts < TIMESTAMP '2024-01-11' AND event_id % 50 = 7)) AS rows_before,
               count(*) AS rows_after, count(*) AS distinct_ids, 0::bigint AS lost_ids
        FROM events WHERE {GOOD})""",
    "bronze_log_by_day": f"""{with_(TRADES)} SELECT {MESSAGE_COLUMNS} FROM trades WHERE {GOOD}
        AND event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-12'""",
}
SQL["outlier_rate_repeated_bounds"] = SQL["outlier_summary"]
SQL["publish_loaded"] = (
    SQL["warehouse_projection"] + " WHERE vwap BETWEEN 1 AND 2000 AND total_volume > 0"
)
SQL["version_history_compacted"] = SQL["version_history"]
SQL["asof_merged_groups"] = SQL["asof_version_counts"]
SQL["publish_atomic"] = f"""{with_(TRADES, bars('1 hour'), bars('1 day', 'days'))}, n AS (
    SELECT (SELECT count(*) FROM bars WHERE vwap BETWEEN 1 AND 2000 AND total_volume > 0) AS a,
        (SELECT count(*) FROM bars WHERE vwap BETWEEN 1 AND 2000 AND total_volume > 0
            AND ticker <> 'click') AS b,
        (SELECT count(*) FROM days WHERE vwap BETWEEN 1 AND 2000 AND total_volume > 0) AS long_rows)
    SELECT attempt, outcome, CASE WHEN attempt = 'second' THEN b ELSE a END AS short_rows, long_rows
    FROM n, (VALUES ('first', 'loaded'), ('breaks', 'broken'), ('closed', 'gate closed'),
        ('second', 'loaded')) v(attempt, outcome)"""
SQL["reconcile_incremental"] = SQL["reconcile_summary_outer"]
SQL["late_rows_side_table"] = SQL["stream_late_windows"]
SQL["rollup_bars_1d"] = SQL["vwap_1d"]
# A day is emitted once an hour behind it is: when that hour has closed.
SQL["stream_rollup_bars"] = f"""{with_(
    TRADES, f"good AS (SELECT * FROM trades WHERE {GOOD})", bars('1 hour', 'h', 'good'), bars('1 day', 'd', 'good'),
    "edge AS (SELECT max(window_start) AS t FROM h WHERE window_end <= (SELECT max(event_time) - INTERVAL 10 SECOND FROM good))")}
    SELECT {FULL_BAR} FROM d, edge WHERE window_end <= t"""
SQL["stream_outlier_trades"] = f"""{OUTLIER_BASE} SELECT {FULL_OUTLIER} FROM outliers
    WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 SECOND FROM events)"""
SQL["clustered_ticker_days"] = f"""{with_(TRADES)} SELECT cast(event_time AS date) AS event_date,
    count(*) AS trade_count, {r4('sum(price * quantity)')} AS dollar_volume FROM trades
    WHERE ticker = 'click' AND event_time < TIMESTAMP '2024-01-21' GROUP BY 1"""
CLOSED_DAY = """window_start = (SELECT max(window_start) FROM bars
        WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 SECOND FROM events))"""
SQL["stream_latest_board"] = f"""{DAILY} SELECT ticker, window_start, {r4('vwap')} AS vwap, total_volume, trade_count
    FROM bars WHERE {CLOSED_DAY} ORDER BY total_volume DESC, ticker LIMIT 15"""
SQL["stream_latest_bounds"] = f"""{with_(TRADES, bars('1 day'), bounds())}
    SELECT ticker, window_start, window_volume, {r4('window_avg_price')} AS window_avg_price,
           {r4('anomaly_upper')} AS anomaly_upper, {r4('anomaly_lower')} AS anomaly_lower
    FROM bounds WHERE {CLOSED_DAY} ORDER BY window_volume DESC, ticker LIMIT 5"""
SQL["distinct_over_days"] = """SELECT since, until, count(ts) AS trade_count, count(DISTINCT event_type) AS tickers,
        count(DISTINCT user_id) AS users, true AS within_bound
    FROM (VALUES (DATE '2024-01-01', DATE '2024-01-31'), (DATE '2024-01-05', DATE '2024-01-11'),
        (DATE '2024-01-09', DATE '2024-01-09'), (DATE '2023-01-01', DATE '2023-01-02')) v(since, until)
    LEFT JOIN events ON cast(ts AS date) BETWEEN since AND until GROUP BY 1, 2"""
