"""Sliding-window price statistics."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.functions import numbers
from tickbars.schemas import SLIDE_DURATION, WINDOW_DURATION


def rolling_stats(
    ticks: DataFrame,
    duration: str = WINDOW_DURATION,
    slide: str = SLIDE_DURATION,
    *,
    harmonic: bool = False,
    closed: Column | None = None,
) -> DataFrame:
    """Mean, geometric mean and deviation of the price per symbol and sliding window.

    Each tick is expanded to its windows inside the task and combined there before the one shuffle, so a busy symbol or
    a burst of ticks costs one row per window and task. ``slide`` equal to ``duration`` gives tumbling windows.

    ``closed`` is a time of each tick (or NULL): windows that end by then do not get the tick.
    """
    stats = [
        numbers.mean_of(ticks, "price").alias("arithmetic_mean"),
        numbers.geometric_mean("price").alias("geometric_mean"),
        numbers.sample_deviation("price").alias("standard_deviation"),
    ]
    if harmonic:
        stats.append(numbers.harmonic_mean("price").alias("harmonic_mean"))
    window = F.window("time_stamp", duration, slide)
    if closed is not None:
        ticks = ticks.withColumn("closed", closed).withColumn("window", window)
        ticks = ticks.where(F.col("closed").isNull() | (F.col("window.end") > F.col("closed")))
        window = F.col("window")
    grouped = ticks.groupBy(window, "symbol_coin").agg(*stats)
    return grouped.withColumns(
        {"start_time": F.col("window").getField("start"), "end_time": F.col("window").getField("end")}
    ).drop("window")


_UNITS = {"microsecond": 1, "millisecond": 10**3, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6,
          "day": 86400 * 10**6, "week": 7 * 86400 * 10**6}


def microseconds(duration: str) -> int:
    """The length of a duration such as ``"5 minutes"`` or ``"1 hour 30 minutes"``."""
    parts = duration.lower().removeprefix("interval ").split()
    if not parts or len(parts) % 2 or not all(n.isdigit() and unit.rstrip("s") in _UNITS for n, unit in _pairs(parts)):
        raise ValueError(f"not a duration of fixed length: {duration!r}")
    return sum(int(n) * _UNITS[unit.rstrip("s")] for n, unit in _pairs(parts))


def _pairs(parts: list[str]) -> list[tuple[str, str]]:
    return list(zip(parts[::2], parts[1::2], strict=True))


def pane_moments(ticks: DataFrame, duration: str, slide: str) -> DataFrame:
    """One row per symbol and pane: count, mean and squared distances of the prices, and what the other means need.

    Panes are as long as the greatest common divisor of ``duration`` and ``slide``, which is the slide itself where it
    divides the duration, so every pane lies in its windows as a whole.
    """
    pane = f"{gcd(microseconds(duration), microseconds(slide))} microseconds"
    price = F.col("price").cast("double")
    return ticks.groupBy(F.window("time_stamp", pane).alias("pane"), "symbol_coin").agg(
        F.struct(F.count("price").alias("n"), F.avg(price).alias("mean"), (F.var_pop(price) * F.count("price")).alias("m2")).alias("moments"),
        F.count("price").alias("n"),
        F.try_sum("price").alias("total"),
        F.count(F.ln(price)).alias("n_log"),
        (F.avg(F.ln(price)) * F.count(F.ln(price))).alias("sum_log"),
    )


def _merged_moments(moments: Column) -> Column:
    """Count, mean and squared distances of several panes together, one pane after the other."""
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def merged(a: Column, b: Column) -> Column:
        n, gap = a["n"] + b["n"], b["mean"] - a["mean"]
        both = F.struct(
            n.alias("n"),
            (a["mean"] + gap * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n).alias("m2"),
        )
        return F.when(b["n"] > 0, both).otherwise(a)

    return F.aggregate(moments, nothing, merged)


def windows_of_panes(panes: DataFrame, duration: str, slide: str) -> DataFrame:
    """Windows put together from their few panes. A pane is placed by its last microsecond, which on a stream carries the
    watermark on to this second aggregation."""
    placed = panes.withColumn("pane_time", F.window_time("pane"))
    windows = placed.groupBy(F.window("pane_time", duration, slide), "symbol_coin").agg(
        F.sum("n").alias("n"),
        F.try_sum("total").alias("total"),
        F.sum("n_log").alias("n_log"),
        F.sum("sum_log").alias("sum_log"),
        # Bounded: one entry per pane of the window.
        F.array_sort(F.collect_list("moments")).alias("parts"),
    )
    m2 = _merged_moments(F.col("parts"))["m2"]
    return windows.select(
        "symbol_coin",
        F.try_divide(F.col("total").cast("double"), F.col("n").cast("double")).alias("arithmetic_mean"),
        F.exp(F.try_divide(F.col("sum_log"), F.col("n_log").cast("double"))).alias("geometric_mean"),
        F.when(F.col("n") > 1, F.sqrt(m2 / (F.col("n") - 1))).alias("standard_deviation"),
        F.col("window.start").alias("start_time"),
        F.col("window.end").alias("end_time"),
    )


def rolling_stats_from_panes(
    ticks: DataFrame, duration: str = WINDOW_DURATION, slide: str = SLIDE_DURATION
) -> DataFrame:
    """The same result through panes, for feeds with many ticks per symbol and slide.

    Every tick is aggregated once, into its pane; only panes are expanded to windows. Deviations are merged from the
    panes' counts, means and squared distances, which unlike a sum of squares keeps its digits when prices are large and
    close together. On sparse feeds, with about one tick per pane, ``rolling_stats`` shuffles less.

    On a stream both aggregations are stateful and share one watermark, in append mode: open panes are one row each, where
    ``rolling_stats`` keeps a row for each window of the tick, and a window is emitted once, when it closes.
    """
    return windows_of_panes(pane_moments(ticks, duration, slide), duration, slide)
