import math
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickbars.operators.rolling import rolling_stats, rolling_stats_from_panes

START = datetime(2024, 1, 1, 10, 0, 5)


def ticks(spark, points, price_type="decimal(38,18)"):
    df = spark.createDataFrame(
        [(symbol, START + timedelta(seconds=s), str(p) if p is not None else None) for symbol, s, p in points],
        "symbol_coin string, time_stamp timestamp, price string",
    )
    return df.withColumn("price", F.col("price").cast(price_type))


def as_map(df):
    return {(r.symbol_coin, r.end_time): r for r in df.collect()}


def test_one_tick_falls_into_ten_windows(spark):
    result = rolling_stats(ticks(spark, [("A", 0, 4)]))
    assert result.columns == ["symbol_coin", "arithmetic_mean", "geometric_mean", "standard_deviation",
                              "start_time", "end_time"]
    found = result.collect()
    assert len(found) == 10
    for row in found:
        assert row.end_time - row.start_time == timedelta(seconds=300)
        assert row.start_time <= START < row.end_time
        assert row.start_time.second % 30 == 0
        assert (row.arithmetic_mean, row.standard_deviation) == (4.0, None)
        assert math.isclose(row.geometric_mean, 4.0)


def test_values_and_zero_prices(spark):
    whole = {"duration": "1 hour", "slide": "1 hour"}
    row = rolling_stats(ticks(spark, [("A", 0, 2), ("A", 1, 8), ("A", 2, 0)]), harmonic=True, **whole).first()
    assert row.arithmetic_mean == 10 / 3
    assert math.isclose(row.geometric_mean, 4.0)  # the zero price has no logarithm
    assert math.isclose(row.harmonic_mean, 1 / ((1 / 2 + 1 / 8) / 2))
    assert math.isclose(row.standard_deviation, statistics.stdev([2, 8, 0]))
    only_zero = rolling_stats(ticks(spark, [("A", 0, 0)]), **whole).first()
    assert (only_zero.arithmetic_mean, only_zero.geometric_mean) == (0.0, None)


def test_a_sum_beyond_the_type_gives_null_not_an_error(spark):
    df = ticks(spark, [("A", s, "99999999999999999999") for s in range(3)] + [("B", 0, 1)])
    whole = ("1 hour", "1 hour")
    for result in (rolling_stats(df, *whole), rolling_stats_from_panes(df, *whole)):
        means = {r.symbol_coin: r.arithmetic_mean for r in result.collect()}
        assert means == {"A": None, "B": 1.0}


def test_tumbling_windows(spark):
    result = rolling_stats(ticks(spark, [("A", s, 1) for s in range(0, 600, 10)]), "300 seconds", "300 seconds")
    assert result.count() == 2


@pytest.mark.parametrize("price_type", ["decimal(38,18)", "double"])
@pytest.mark.parametrize("window", [("300 seconds", "30 seconds"), ("10 minutes", "5 minutes"), ("1 hour", "1 hour"), ("5 minutes", "2 minutes")])
def test_panes_equal_direct(spark, price_type, window):
    points = [("AB"[i % 2], i * 7 % 1700, 100 + (i * i) % 13) for i in range(300)] + [("C", 3, 5), ("C", 4, None), ("D", 9, 0)]
    df = ticks(spark, points, price_type)
    direct, panes = as_map(rolling_stats(df, *window)), as_map(rolling_stats_from_panes(df, *window))
    assert direct.keys() == panes.keys()
    for key, want in direct.items():
        got = panes[key]
        for name in ("arithmetic_mean", "geometric_mean", "standard_deviation"):
            a, b = want[name], got[name]
            assert (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)), (key, name)


def test_pane_deviation_keeps_its_digits(spark):
    """Large prices close together, where a sum of squares would be all rounding error."""
    prices = [1e9 + i / 1000 for i in range(200)]
    df = ticks(spark, [("A", i, p) for i, p in enumerate(prices)], "double")
    row = rolling_stats_from_panes(df, "1 hour", "30 seconds").where("standard_deviation is not null")
    want = statistics.stdev(prices)
    best = max(r.standard_deviation for r in row.collect())
    assert math.isclose(best, want, rel_tol=1e-6)


def test_burst_is_combined_before_the_shuffle(spark):
    from compare import plan

    text = plan(rolling_stats(ticks(spark, [("A", 0, 1)])))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_stddev_samp" in text and "SortAggregate" not in text
