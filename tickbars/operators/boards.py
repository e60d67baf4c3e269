"""Winner, loser and market-share boards.

On a stream these run in complete mode, whose state is one row per coin and is never dropped: they are meant for a
bounded set of coins, not for keys that grow without end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.schemas import BOARD_SIZE


def per_coin(metrics: DataFrame, columns: list[str], pick: str) -> DataFrame:
    """One row per coin over everything seen.

    ``pick="max"`` takes each column's own maximum, which need not come from one tick; ``"latest"`` takes the newest
    tick as a whole.
    """
    grouped = metrics.groupBy("name_coin")
    if pick == "max":
        return grouped.agg(
            F.max("time_stamp").alias("time_stamp"), *[F.max(name).alias(name) for name in columns]
        )
    if pick == "latest":
        row = F.struct("time_stamp", *columns)
        return grouped.agg(F.max(row).alias("newest")).select("name_coin", "newest.*")
    raise ValueError(f"pick must be 'max' or 'latest', not {pick!r}")


def board(rows: DataFrame, order: Column, n: int) -> DataFrame:
    return rows.orderBy(order, F.col("name_coin").asc()).limit(n)


def leaders(metrics: DataFrame, pick: str = "max") -> DataFrame:
    return per_coin(metrics, ["price", "percent_change"], pick)


def shares(metrics: DataFrame, pick: str = "max") -> DataFrame:
    return per_coin(metrics, ["percent_volume", "percent_market_cap"], pick)


def top_winners(metrics: DataFrame, n: int = BOARD_SIZE, pick: str = "max") -> DataFrame:
    return board(leaders(metrics, pick), F.col("percent_change").desc_nulls_last(), n)


def top_losers(metrics: DataFrame, n: int = BOARD_SIZE, pick: str = "max") -> DataFrame:
    """Smallest change first; a coin without a known change is not a loser."""
    return board(leaders(metrics, pick), F.col("percent_change").asc_nulls_last(), n)


def market_share(metrics: DataFrame, n: int = BOARD_SIZE, pick: str = "max") -> DataFrame:
    return board(shares(metrics, pick), F.col("percent_market_cap").desc_nulls_last(), n)


def ranked_winners(metrics: DataFrame, n: int = BOARD_SIZE, pick: str = "max") -> DataFrame:
    """Coins whose rank by change is at most ``n``, ties included; on a stream, for use inside a micro-batch.

    As in ``top_ranked``, a filter against the n-th largest change. That change is looked up over whole rows, so that
    both sides are the same aggregate: Spark scans and shuffles the ticks for one of them and reuses it for the other.
    """
    coins = leaders(metrics, pick).where(F.col("percent_change").isNotNull())
    others = [name for name in coins.columns if name != "percent_change"]
    best = coins.orderBy(F.col("percent_change").desc(), *others).limit(n)
    return coins.where(F.col("percent_change") >= best.agg(F.min("percent_change")).scalar())
