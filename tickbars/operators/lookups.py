"""Reads that the result tables are keyed for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _newest_first(df: DataFrame, symbol: str, time: str, start, end) -> DataFrame:
    rows = df.where(F.col("symbol_coin") == symbol)
    if start is not None:
        rows = rows.where(F.col(time) >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col(time) < F.lit(end))
    return rows.orderBy(F.col(time).desc())


def price_history(prices: DataFrame, symbol: str, start=None, end=None) -> DataFrame:
    """Prices of one symbol in ``[start, end)``, newest first."""
    return _newest_first(prices, symbol, "time_stamp", start, end)


def rolling_history(means: DataFrame, symbol: str, start=None, end=None) -> DataFrame:
    """Window statistics of one symbol whose windows end in ``[start, end)``, newest first."""
    return _newest_first(means, symbol, "end_time", start, end)


def winners_view(snapshot: DataFrame) -> DataFrame:
    """One snapshot of the winners, biggest gain first."""
    return snapshot.orderBy(F.col("percent_change").desc_nulls_last(), "name_coin")


def losers_view(snapshot: DataFrame) -> DataFrame:
    """One snapshot of the losers, biggest loss first."""
    return snapshot.orderBy(F.col("percent_change").asc_nulls_last(), "name_coin")


def share_view(snapshot: DataFrame) -> DataFrame:
    """One snapshot of the market shares, biggest share first."""
    return snapshot.orderBy(F.col("percent_market_cap").desc_nulls_last(), "name_coin")


def bar_lookup(bars: DataFrame, name: str, grain: str, period: str) -> DataFrame:
    """The bar of one asset and one ``yyyy-MM`` month or ``yyyy`` year."""
    return bars.where((F.col("name") == name) & (F.col(grain) == period))
