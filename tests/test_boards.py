from datetime import datetime

import pytest
from compare import plan

from tickbars.operators import boards

T0 = datetime(2024, 1, 1)


def metrics(spark, data):
    return spark.createDataFrame(
        [(name, datetime(2024, 1, 1, 0, 0, t), price, change, vol, cap) for name, t, price, change, vol, cap in data],
        "name_coin string, time_stamp timestamp, price double, percent_change double, percent_volume double,"
        "percent_market_cap double",
    )


DATA = [
    ("a", 1, 10.0, 5.0, 1.0, 3.0),
    ("a", 2, 8.0, -2.0, 2.0, 1.0),
    ("b", 1, 1.0, 5.0, 9.0, 9.0),
    ("c", 1, 2.0, None, 4.0, 4.0),
    ("d", 3, 3.0, -7.0, 5.0, None),
]


def names(df):
    return [r.name_coin for r in df.collect()]


def test_independent_maxima(spark):
    row = boards.leaders(metrics(spark, DATA)).where("name_coin = 'a'").first()
    assert (row.price, row.percent_change, row.time_stamp.second) == (10.0, 5.0, 2)


def test_latest_takes_one_row(spark):
    row = boards.leaders(metrics(spark, DATA), "latest").where("name_coin = 'a'").first()
    assert (row.price, row.percent_change, row.time_stamp.second) == (8.0, -2.0, 2)
    with pytest.raises(ValueError, match="pick"):
        boards.leaders(metrics(spark, DATA), "mean")


def test_order_ties_and_unknown_changes(spark):
    df = metrics(spark, DATA)
    assert names(boards.top_winners(df)) == ["a", "b", "d", "c"]
    assert names(boards.top_losers(df)) == ["d", "a", "b", "c"]
    assert names(boards.top_losers(df, 2)) == ["d", "a"]
    assert names(boards.market_share(df)) == ["b", "c", "a", "d"]


def test_ten_rows_at_most_with_ties(spark):
    df = metrics(spark, [(f"c{i:02}", 1, 1.0, 1.0, 1.0, 1.0) for i in range(25)])
    for n in (1, 6):
        assert names(boards.top_winners(df.repartition(n))) == [f"c{i:02}" for i in range(10)]


def test_plan(spark):
    text = plan(boards.top_winners(metrics(spark, DATA)))
    assert "TakeOrderedAndProject" in text and "SortAggregate" not in text
    assert text.count("Exchange") == 1


def test_ranked_winners_keep_ties(spark):
    df = metrics(spark, DATA + [("e", 1, 1.0, -7.0, 1.0, 1.0)])
    assert sorted(names(boards.ranked_winners(df, 1))) == ["a", "b"]
    assert sorted(names(boards.ranked_winners(df, 3))) == ["a", "b", "d", "e"]


@pytest.mark.parametrize("pick", ["max", "latest"])
def test_ranked_winners_aggregate_once(spark, sf_dir, pick):
    from tickbars.functions.metrics import percent_change
    from tickbars.plans import tables

    ticks = tables.ticks(spark, sf_dir).withColumn("percent_change", percent_change())
    ranked = boards.ranked_winners(ticks, pick=pick)
    assert ranked.collect()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    assert "ReusedExchange" in ranked._jdf.queryExecution().explainString(mode)
