"""Ranked subsets of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickbars.operators.quality import drop_incomplete
from tickbars.schemas import BAR, BOARD_SIZE


def top_ranked(df: DataFrame, by: str, n: int = BOARD_SIZE) -> DataFrame:
    """Rows whose ``rank()`` over ``by`` descending is at most ``n``, ties included.

    A row has rank <= n exactly if its value reaches the n-th largest value, duplicates counted. That value comes from a
    top-n over the one column, and the rows from a filter on it, which the scan can use to skip row groups. No row is
    shuffled, and a tie of any size stays spread over the tasks that read it; a global rank window would bring all tied
    rows to one task.
    """
    present = df.where(F.col(by).isNotNull())
    lowest = present.select(by).orderBy(F.col(by).desc()).limit(n).agg(F.min(by)).scalar()
    return present.where(F.col(by) >= lowest)


#: Parts in which the values of one group are looked through before they meet.
SALTS = 32


def group_thresholds(df: DataFrame, by: str, group: str, n: int, salts: int = SALTS) -> DataFrame:
    """The ``n``-th largest value of each group, duplicates counted; the smallest one where there are fewer.

    Equal values of a group are counted first, so ties of any size are one row. Of these rows each salted part of a group
    keeps ``n``, already in the task that made them, and at most n * salts meet to find the threshold.
    """
    values = df.groupBy(group, by).agg(F.count(F.lit(1)).alias("times"))
    salted = values.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(salts)))
    place = F.row_number().over(Window.partitionBy(group, "salt").orderBy(F.col(by).desc()))
    some = salted.withColumn("place", place).where(F.col("place") <= n).drop("salt", "place")
    above = Window.partitionBy(group).orderBy(F.col(by).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = some.withColumn("above", F.coalesce(F.sum("times").over(above), F.lit(0)))
    return ranked.where(F.col("above") < n).groupBy(group).agg(F.min(by).alias("threshold"))


def top_ranked_by(df: DataFrame, by: str, group: str, n: int = BOARD_SIZE) -> DataFrame:
    """Rows whose ``rank()`` over ``by`` descending within their group is at most ``n``, ties included.

    Rows are compared with their group's threshold: one row per group, joined as its size allows, so a group with a third
    of all rows and ties of any size stay spread over the tasks. A NULL group is a group.
    """
    present = df.where(F.col(by).isNotNull())
    thresholds = group_thresholds(present, by, group, n).withColumnRenamed(group, "threshold_group")
    found = present.join(thresholds, F.col(group).eqNullSafe(F.col("threshold_group")))
    return found.where(F.col(by) >= F.col("threshold")).drop("threshold_group", "threshold")


def top_bars_by_asset(bars: DataFrame, n: int = BOARD_SIZE, by: str = "Marketcap") -> DataFrame:
    """The ``n`` highest bars of every asset, ties included, in result-table columns."""
    return _top_columns(top_ranked_by(drop_incomplete(bars, BAR.fieldNames()), by, "Name", n))


def top_bars(bars: DataFrame, n: int = BOARD_SIZE, by: str = "Marketcap") -> DataFrame:
    """The ``n`` highest bars over all assets and days, ties included, in result-table columns."""
    return _top_columns(top_ranked(drop_incomplete(bars, BAR.fieldNames()), by, n))


def _top_columns(top: DataFrame) -> DataFrame:
    return top.select(
        F.col("Name").alias("name_coin"),
        F.col("Symbol").alias("symbol_coin"),
        F.col("Date").alias("date"),
        F.col("High").alias("high"),
        F.col("Low").alias("low"),
        F.col("Open").alias("open"),
        F.col("Close").alias("close"),
        F.col("Volume").alias("volume"),
        F.col("Marketcap").alias("market_cap"),
    )
