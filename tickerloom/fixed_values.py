"""Column contracts, symbol lists and limits that results depend on."""

# --- wire and table contracts (Spark DDL text) ---

TRADE_MESSAGE = """
    trade_id string, ticker string, price double, quantity int, side string,
    trade_type string, bid_price double, ask_price double, timestamp string,
    exchange string, source string
"""

VENDOR_BATCH = "type string, data array<struct<s: string, p: double, v: double, t: bigint>>"

MESSAGE_FRAME = """
    key binary, value binary, topic string, partition int, offset bigint,
    timestamp timestamp
"""

BRONZE_COLUMNS = [
    "trade_id", "ticker", "price", "quantity", "side", "trade_type",
    "exchange", "source", "event_time", "kafka_ingest_time", "dollar_volume",
]

BAR_COLUMNS = [
    "ticker", "vwap", "low_price", "high_price", "avg_price", "total_volume",
    "total_dollar_volume", "trade_count", "buy_volume", "avg_bid", "avg_ask",
    "sell_volume", "buy_pressure", "avg_spread", "window_start", "window_end",
    "window_duration",
]

BOUND_COLUMNS = [
    "ticker", "window_avg_price", "window_volume", "window_trade_count",
    "window_start", "window_end", "anomaly_upper", "anomaly_lower",
    "threshold_pct",
]

WAREHOUSE_COLUMNS = [
    "WINDOW_START", "WINDOW_END", "TICKER", "VWAP", "LOW_PRICE", "HIGH_PRICE",
    "AVG_PRICE", "TOTAL_VOLUME", "TOTAL_DOLLAR_VOLUME", "TRADE_COUNT",
    "BUY_VOLUME", "SELL_VOLUME", "BUY_PRESSURE", "AVG_SPREAD", "AVG_BID",
    "AVG_ASK",
]

# --- symbols: ticker, base price, sector (AMZN is "Other") ---

SECTOR_ROWS = [
    ("AAPL", 210, "Technology"),
    ("MSFT", 470, "Technology"),
    ("NVDA", 140, "Technology"),
    ("GOOGL", 185, "Technology"),
    ("AMZN", 215, "Other"),
    ("META", 530, "Technology"),
    ("TSLA", 280, "Automotive"),
    ("BRK-B", 475, "Finance"),
    ("JPM", 230, "Finance"),
    ("V", 310, "Finance"),
    ("JNJ", 165, "Healthcare"),
    ("WMT", 95, "Consumer"),
    ("PG", 170, "Consumer"),
    ("MA", 530, "Finance"),
    ("HD", 390, "Consumer"),
    ("CVX", 155, "Energy"),
    ("MRK", 130, "Healthcare"),
    ("ABBV", 195, "Healthcare"),
    ("PEP", 170, "Consumer"),
    ("KO", 65, "Consumer"),
    ("COST", 950, "Consumer"),
    ("BAC", 45, "Finance"),
    ("AVGO", 185, "Technology"),
    ("TMO", 575, "Healthcare"),
    ("LLY", 950, "Healthcare"),
]

UNIVERSE = [row[0] for row in SECTOR_ROWS]

# Symbols whose VWAP is normally above the contamination limit.
HIGH_PRICED = ["LLY", "COST", "TMO", "MA", "BRK-B", "MSFT", "META"]

# --- limits ---

WATERMARK = "10 seconds"
TRIGGER = "10 seconds"
THRESHOLD_PCT = 2.0

EXACT_DIFF_PCT = 0.01
CLOSE_DIFF_PCT = 1.0
PASSED_PCT = 99.0
CLOSE_PCT = 95.0

VWAP_MIN = 1
VWAP_MAX = 2000
BULLISH_ABOVE = 55
BEARISH_BELOW = 45
HIGH_VOLUME_FACTOR = 1.5
BALANCED_SKEW = 2
CONTAMINATION_VWAP = 500

# Late-data check: source tag, id prefix -> rows expected in bronze.
LATE_SOURCE = "late_data_demo"
LATE_PHASES = {"ontime": 20, "late-within": 5, "late-beyond": 5}
