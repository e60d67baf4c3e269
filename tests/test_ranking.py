import pytest
from compare import plan
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickbars.operators.ranking import top_bars, top_ranked


def by_window(df, n):
    ranked = df.withColumn("rank", F.rank().over(Window.orderBy(F.col("v").desc())))
    return sorted(r.i for r in ranked.where(F.col("v").isNotNull() & (F.col("rank") <= n)).collect())


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, v double").repartition(3)


@pytest.mark.parametrize(
    "values",
    [
        [5.0, 4.0, 4.0, 4.0, 1.0],
        [7.0] * 12,
        [1.0],
        [],
        [None, 2.0, None, 3.0],
        [None, None],
        [float("nan"), float("inf"), 1.0, 2.0],
    ],
)
@pytest.mark.parametrize("n", [1, 2, 3, 10])
def test_equals_rank(spark, values, n):
    df = frame(spark, values)
    assert sorted(r.i for r in top_ranked(df, "v", n).collect()) == by_window(df, n)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(0, 6).map(float), max_size=30), n=st.integers(1, 12))
def test_equals_rank_on_random_ties(spark, values, n):
    df = frame(spark, values)
    assert sorted(r.i for r in top_ranked(df, "v", n).collect()) == by_window(df, n)


def test_rows_are_neither_shuffled_nor_gathered(spark, sf_dir):
    from tickbars.plans import tables

    text = plan(top_bars(tables.bars(spark, sf_dir), by="Volume"))
    assert "Exchange" not in text and "Window" not in text
    assert "TakeOrderedAndProject" in text
    assert "GreaterThanOrEqual(l_quantity,ScalarSubquery" in text


def test_columns(spark, sf_dir):
    from tickbars.plans import tables

    top = top_bars(tables.bars(spark, sf_dir))
    assert top.columns == "name_coin symbol_coin date high low open close volume market_cap".split()
