from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.functions.metrics import percent_change, ratio
from tickbars.operators import live
from tickbars.schemas import TICK


def tick(spark, **fields):
    money = "volume market_cap price price_old total_24_volume total_market_cap".split()
    values = {name: None for name in TICK.fieldNames()} | {
        k: Decimal(str(v)) if k in money and v is not None else v for k, v in fields.items()
    }
    return spark.createDataFrame([tuple(values[name] for name in TICK.fieldNames())], TICK)


BASE = dict(name_coin="A", symbol_coin="a", id="1", volume="10.5", market_cap=2000, price="3.25", price_old=3,
            total_24_volume=1000, total_market_cap=8000)


def test_values(spark):
    row = live.with_metrics(tick(spark, **BASE)).first()
    assert row.percent_volume == 1.05
    assert row.percent_market_cap == 25.0
    assert row.percent_change == 100 * 0.25 / 3
    assert row.cir_supply == 2000 / 3.25


def test_decimal_mode_has_six_decimals(spark):
    df = live.with_metrics(tick(spark, **BASE), "decimal")
    assert df.schema["percent_change"].dataType == T.DecimalType(38, 6)
    row = df.first()
    assert row.percent_volume == Decimal("1.050000")
    assert row.percent_change == Decimal("8.333333")
    assert row.cir_supply == Decimal("615.384615")


@pytest.mark.parametrize("as_type", ["double", "decimal"])
def test_zero_denominators_give_null(spark, as_type):
    zeros = dict(BASE, price=0, price_old=0, total_24_volume=0, total_market_cap=0)
    row = live.with_metrics(tick(spark, **zeros), as_type).first()
    assert (row.percent_volume, row.percent_market_cap, row.percent_change, row.cir_supply) == (None,) * 4


def test_difference_is_taken_before_rounding_to_double(spark):
    row = live.with_metrics(tick(spark, **dict(BASE, price="50000.01", price_old="50000"))).first()
    assert row.percent_change == 100 * 0.01 / 50000


def test_too_many_digits_give_null_in_decimal_mode(spark):
    huge = dict(BASE, volume="99999999999999999999.9", total_24_volume="0.000000000000000001")
    row = live.with_metrics(tick(spark, **huge), "decimal").first()
    assert row.percent_volume is None
    assert row.percent_change == Decimal("8.333333")


def test_unknown_type():
    with pytest.raises(ValueError, match="as_type"):
        ratio(F.lit(1), F.lit(2), as_type="float")


def test_live_price_columns(spark):
    live_row = live.live_prices(tick(spark, **BASE))
    assert sorted(live_row.columns) == sorted(
        "name_coin symbol_coin volume market_cap cir_supply price percent_change percent_volume percent_market_cap "
        "time_stamp".split()
    )


def test_daily_totals_stay_on_the_ticks_partitions(spark, sf_dir):
    from compare import plan

    from tickbars.plans import tables

    text = plan(live.with_daily_totals(tables.ticks(spark, sf_dir)))
    assert "BroadcastHashJoin" in text and "Window" not in text
    # The only shuffle is that of the per-day sums, each already combined per task.
    assert text.count("Exchange hashpartitioning") == 1 and "partial_try_sum" in text


def test_snapshot_totals_with_one_hot_snapshot(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).alias("poll"),
        F.lit(2).cast("decimal(38,18)").alias("volume"),
        F.lit(3).cast("decimal(38,18)").alias("market_cap"),
    )
    hot = live.with_snapshot_totals(df, "poll").where("poll = 0")
    assert hot.count() == 2000
    assert hot.select("total_24_volume", "total_market_cap").distinct().collect() == [(Decimal(4000), Decimal(6000))]


def test_latest_per_key_breaks_ties_by_content(spark):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 5, None), ("b", 4, "q")]
    df = spark.createDataFrame(data, "k string, t int, v string")
    for n in (1, 2, 5):
        latest = live.latest_per_key(df.repartition(n), ["k"], ["t"])
        assert latest.columns == ["k", "t", "v"]
        assert sorted(map(tuple, latest.collect())) == [("a", 2, "z"), ("b", 5, None)]


def test_percent_change_keeps_the_eighteenth_decimal(spark):
    prices = "cast(0.000000000000000002 as decimal(38,18)) price, cast(0.000000000000000004 as decimal(38,18)) price_old"
    row = spark.range(1).selectExpr(*prices.split(", ")).select(percent_change().alias("change")).first()
    assert row.change == -50.0
