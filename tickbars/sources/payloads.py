"""Ticks out of nested API payload documents."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.schemas import MONEY, PAYLOAD, TICK

LANDED_PAYLOAD = T.StructType(
    [T.StructField("fetched_at", T.LongType()), T.StructField("body", T.StringType())]
)

# 9999-12-31 23:59:59: seconds beyond the years Spark prints are a unit mistake, and huge ones would not even convert.
LAST_SECOND = 253_402_300_799


def read_payloads(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Landed payloads: one JSON line per poll, with its fetch time in epoch seconds and the response text."""
    return spark.read.schema(LANDED_PAYLOAD).json(paths)


def _money(column: Column) -> Column:
    return column.try_cast(MONEY)


def flatten_payloads(payloads: DataFrame, body: str = "body", fetched_at: str = "fetched_at") -> DataFrame:
    """One tick per coin of each document, with ``is_valid`` telling whether every field it needs was there.

    The poll's totals stay beside the coins through the explode, so no join is needed. A coin with a missing or
    unreadable field is marked and the other coins of its document go on. A document that cannot be read, or has no
    coins, gives one row of its own that is not valid.
    """
    document = F.from_json(F.col(body).cast("string"), PAYLOAD, {"mode": "PERMISSIVE"})
    seconds = F.col(fetched_at)
    fetched = F.when(seconds.between(0, LAST_SECOND), F.timestamp_seconds(seconds))
    coins = payloads.select(
        fetched.alias("time_stamp"), document.getField("data").alias("data")
    ).select("time_stamp", F.col("data.stats").alias("stats"), F.explode_outer("data.coins").alias("coin"))

    price = _money(F.col("coin.price"))
    trend = F.col("coin.sparkline")
    has_trend = F.size(trend) > 1
    ticks = coins.select(
        F.col("coin.name").alias("name_coin"),
        F.col("coin.symbol").alias("symbol_coin"),
        F.col("coin.uuid").alias("id"),
        _money(F.col("coin.24hVolume")).alias("volume"),
        _money(F.col("coin.marketCap")).alias("market_cap"),
        price.alias("price"),
        F.when(has_trend, _money(F.get(trend, F.lit(0)))).otherwise(price).alias("price_old"),
        F.col("coin.change").try_cast("double").alias("percent_change_24hr"),
        _money(F.col("stats.total24hVolume")).alias("total_24_volume"),
        _money(F.col("stats.totalMarketCap")).alias("total_market_cap"),
        "time_stamp",
        trend.isNotNull().alias("has_sparkline"),
    )
    needed = [F.col(name).isNotNull() for name in TICK.fieldNames()] + [F.col("has_sparkline")]
    return ticks.withColumn("is_valid", reduce(and_, needed)).drop("has_sparkline")


def payload_ticks(payloads: DataFrame, **columns: str) -> DataFrame:
    """The valid ticks of the documents."""
    return flatten_payloads(payloads, **columns).where("is_valid").drop("is_valid")


def payload_rejects(payloads: DataFrame, **columns: str) -> DataFrame:
    """The coins left out of ``payload_ticks``, and a row for each document that gives none."""
    return flatten_payloads(payloads, **columns).where(~F.col("is_valid")).drop("is_valid")
