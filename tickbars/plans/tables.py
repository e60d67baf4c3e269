"""Ticks, bars, quotes and payload documents out of the given ``events`` and ``lineitem`` tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.operators.live import with_daily_totals
from tickbars.schemas import BAR

# Ids of one payload document lie within a block of this size, which bounds its coins.
COINS_PER_PAYLOAD = 100


def _cents(column: Column) -> Column:
    """Money of the test tables has two decimals; as a decimal it sums exactly."""
    return column.cast("decimal(18,2)")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks without poll totals, in the zone-less time of the table."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select("event_id", "user_id", "event_type", "value", "ts", k.alias("k")).select(
        F.concat(F.lit("coin_"), F.col("user_id")).alias("name_coin"),
        F.col("event_type").alias("symbol_coin"),
        F.col("event_id").cast("string").alias("id"),
        _cents(F.col("value") * 10).alias("volume"),
        _cents(F.col("value") * (F.col("k") + 1)).alias("market_cap"),
        _cents(F.col("value")).alias("price"),
        _cents(F.col("k")).alias("price_old"),
        (F.col("k") - 50).cast("double").alias("percent_change_24hr"),
        F.col("ts").alias("time_stamp"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars; the sequence number is not unique here, so first and last need the prices to break ties."""
    return _bars_of(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def _bars_of(lines: DataFrame, *others: str) -> DataFrame:
    price, tax, discount = F.col("l_extendedprice"), F.col("l_tax"), F.col("l_discount")
    return lines.select(
        *others,
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("SNo"),
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("Name"),
        F.col("l_returnflag").alias("Symbol"),
        F.col("l_shipdate").cast("date").alias("Date"),
        (price * (1 + tax)).alias("High"),
        (price * (1 - discount)).alias("Low"),
        price.alias("Open"),
        (price * (1 - discount) * (1 + tax)).alias("Close"),
        F.col("l_quantity").alias("Volume"),
        (price * F.col("l_quantity")).alias("Marketcap"),
    )


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per asset and day, as bar files have it; its sequence number is the day number.

    An asset has few lines a day, so combining them before the shuffle would save next to nothing: the lines are dealt as
    they are, at half the width of the prices that follow from them.
    """
    lines, day = spark.read.parquet(f"{sf_dir}/lineitem.parquet"), F.col("l_shipdate").cast("date")
    dealt = lines.withColumn("l_shipdate", day).repartition("l_suppkey", "l_shipdate")
    position = F.struct("SNo", "Open", "Close")
    days = _bars_of(dealt, "l_suppkey", "l_shipdate").groupBy("l_suppkey", "l_shipdate").agg(
        F.min("Symbol").alias("Symbol"),
        F.max("High").alias("High"),
        F.min("Low").alias("Low"),
        F.min_by("Open", position).alias("Open"),
        F.max_by("Close", position).alias("Close"),
        F.sum("Volume").alias("Volume"),
        F.round(F.sum("Marketcap"), 2).alias("Marketcap"),
    )
    name, date = F.concat(F.lit("S"), F.col("l_suppkey")), F.col("l_shipdate")
    return days.withColumns({"Name": name, "Date": date, "SNo": F.unix_date(date)}).select(*BAR.fieldNames())


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).select(
        F.col("Name").alias("name1"), _cents(F.col("Open")).alias("price"), F.col("Marketcap").alias("marketCap")
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload documents: the ticks of one day within one block of ids, the day's totals as stats.

    Ids are unique, so no document collects more than ``COINS_PER_PAYLOAD`` coins whatever the size of the table.
    """
    rows = with_daily_totals(ticks(spark, sf_dir))
    block = F.floor(F.col("id").cast("long") / COINS_PER_PAYLOAD)
    # Short price trends of zero, one and two points take every branch of the old-price rule.
    points = F.array(F.col("price_old").cast("string"), F.col("price").cast("string"))
    trend = F.slice(points, F.lit(1), F.pmod(F.col("price_old").cast("int"), F.lit(3)))
    coin = F.struct(
        F.col("id").alias("uuid"),
        F.col("symbol_coin").alias("symbol"),
        F.col("name_coin").alias("name"),
        F.col("volume").cast("string").alias("24hVolume"),
        F.col("market_cap").cast("string").alias("marketCap"),
        F.col("price").cast("string").alias("price"),
        F.col("percent_change_24hr").cast("string").alias("change"),
        trend.alias("sparkline"),
    )
    documents = rows.groupBy(F.col("time_stamp").cast("date").alias("day"), block.alias("block")).agg(
        F.collect_list(coin).alias("coins"),
        F.first("total_24_volume").cast("string").alias("total24hVolume"),
        F.first("total_market_cap").cast("string").alias("totalMarketCap"),
        F.max(F.unix_seconds(F.col("time_stamp").cast("timestamp"))).alias("fetched_at"),
    )
    data = F.struct(F.struct("total24hVolume", "totalMarketCap").alias("stats"), "coins")
    return documents.select("fetched_at", F.to_json(F.struct(data.alias("data"))).alias("body"))
