"""Input and result relations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------------------------------
# Field names, types, durations and sizes that inputs and results have to match.
# ---------------------------------------------------------------------------------------------------------------------

TOPIC = "crypto"
TOPIC_FORMAT = "kafka"
STORE_FORMAT = "org.apache.spark.sql.cassandra"
POLL_INTERVAL = "15 seconds"
WATERMARK = "300 seconds"
WINDOW_DURATION = "300 seconds"
SLIDE_DURATION = "30 seconds"
BOARD_SIZE = 10

MONEY = T.DecimalType(38, 18)

TICK = T.StructType(
    [
        T.StructField("name_coin", T.StringType()),
        T.StructField("symbol_coin", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("volume", MONEY),
        T.StructField("market_cap", MONEY),
        T.StructField("price", MONEY),
        T.StructField("price_old", MONEY),
        T.StructField("percent_change_24hr", T.DoubleType()),
        T.StructField("total_24_volume", MONEY),
        T.StructField("total_market_cap", MONEY),
        T.StructField("time_stamp", T.TimestampType()),
    ]
)

BAR = T.StructType(
    [
        T.StructField("SNo", T.IntegerType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Symbol", T.StringType()),
        T.StructField("Date", T.DateType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Volume", T.DoubleType()),
        T.StructField("Marketcap", T.DoubleType()),
    ]
)

QUOTE = T.StructType(
    [
        T.StructField("name1", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("marketCap", T.DoubleType()),
    ]
)

# Numbers in a payload come as JSON strings or JSON numbers; reading them as text keeps every digit.
PAYLOAD = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField(
                        "stats",
                        T.StructType(
                            [
                                T.StructField("total24hVolume", T.StringType()),
                                T.StructField("totalMarketCap", T.StringType()),
                            ]
                        ),
                    ),
                    T.StructField(
                        "coins",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("uuid", T.StringType()),
                                    T.StructField("symbol", T.StringType()),
                                    T.StructField("name", T.StringType()),
                                    T.StructField("24hVolume", T.StringType()),
                                    T.StructField("marketCap", T.StringType()),
                                    T.StructField("price", T.StringType()),
                                    T.StructField("change", T.StringType()),
                                    T.StructField("sparkline", T.ArrayType(T.StringType())),
                                ]
                            )
                        ),
                    ),
                ]
            ),
        )
    ]
)


@dataclass(frozen=True)
class ResultTable:
    """Contract of a keyed result table: one row per ``keys``, the newest write wins."""

    name: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    keyspace: str


REALTIME_PRICES = ResultTable(
    "crypto_realtime_prices",
    (
        "name_coin",
        "symbol_coin",
        "volume",
        "market_cap",
        "cir_supply",
        "price",
        "percent_change",
        "percent_volume",
        "percent_market_cap",
        "time_stamp",
    ),
    ("symbol_coin", "time_stamp"),
    "crypto",
)
ROLLING_MEANS = ResultTable(
    "crypto_rolling_means",
    ("symbol_coin", "arithmetic_mean", "geometric_mean", "standard_deviation", "start_time", "end_time"),
    ("symbol_coin", "end_time"),
    "crypto",
)
MARKET_SHARE = ResultTable(
    "market_share",
    ("time_stamp", "name_coin", "percent_market_cap", "percent_volume"),
    ("time_stamp", "percent_market_cap", "name_coin"),
    "crypto",
)
BIGGEST_WINNERS = ResultTable(
    "biggest_winners",
    ("time_stamp", "name_coin", "price", "percent_change"),
    ("time_stamp", "percent_change", "name_coin"),
    "crypto",
)
BIGGEST_LOSERS = ResultTable(
    "biggest_losers",
    ("time_stamp", "name_coin", "price", "percent_change"),
    ("time_stamp", "percent_change", "name_coin"),
    "crypto",
)
MONTH_BARS = ResultTable(
    "crypto_month_agg",
    (
        "name",
        "month",
        "highest_high",
        "lowest_low",
        "first_open",
        "last_close",
        "total_volume",
        "total_marketcap",
    ),
    ("name", "month"),
    "crypto_batch",
)
YEAR_BARS = ResultTable(
    "crypto_year_agg",
    (
        "name",
        "year",
        "highest_high",
        "lowest_low",
        "first_open",
        "last_close",
        "total_volume",
        "total_marketcap",
    ),
    ("name", "year"),
    "crypto_batch",
)
ASSET_SUMMARY = ResultTable(
    "crypto_summary",
    ("name", "avg_price", "min_price", "max_price", "max_market_cap"),
    ("name",),
    "crypto_batch",
)
TOP_MARKETCAP = ResultTable(
    "top_marketcap",
    ("name_coin", "symbol_coin", "date", "high", "low", "open", "close", "volume", "market_cap"),
    ("market_cap", "name_coin"),
    "crypto_batch",
)

RESULT_TABLES: dict[str, ResultTable] = {
    table.name: table
    for table in (
        REALTIME_PRICES,
        ROLLING_MEANS,
        MARKET_SHARE,
        BIGGEST_WINNERS,
        BIGGEST_LOSERS,
        MONTH_BARS,
        YEAR_BARS,
        ASSET_SUMMARY,
        TOP_MARKETCAP,
    )
}
