from datetime import datetime
from decimal import Decimal

import pytest
from compare import rows
from pyspark.sql import functions as F

from tickbars.functions.messages import parse_ticks, reject_reason, to_messages
from tickbars.operators.quality import split
from tickbars.schemas import TICK

GOOD = '{"name_coin":"Alpha","symbol_coin":"ALP","id":"u1","price":1.5,"time_stamp":1715089953}'


def parse(spark, *messages):
    return parse_ticks(spark.createDataFrame([(m,) for m in messages], "value string"))


def parse_one(spark, message):
    return parse(spark, message).first()


def test_schema_and_epoch_seconds(spark):
    df = parse(spark, GOOD)
    assert df.schema == TICK
    row = df.first()
    assert (row.name_coin, row.price, row.time_stamp) == ("Alpha", Decimal("1.5"), datetime(2024, 5, 7, 13, 52, 33))
    assert row.volume is None


def test_bytes_are_accepted(spark):
    df = spark.createDataFrame([(GOOD,)], "value string").select(F.col("value").cast("binary").alias("value"))
    assert parse_ticks(df).first().symbol_coin == "ALP"


@pytest.mark.parametrize(
    ("price", "want"),
    [
        ('"2.25"', Decimal("2.25")),
        ("8.12E-6", Decimal("0.00000812")),
        ("1e-20", Decimal(0)),
        ('"xx"', None),
        ("123456789012345678901234567890", None),
        ("null", None),
    ],
)
def test_prices(spark, price, want):
    row = parse_one(spark, GOOD.replace("1.5", price))
    assert row.price == want
    assert row.name_coin == "Alpha"


@pytest.mark.parametrize(
    ("message", "reason"),
    [
        (GOOD, None),
        ("not json", "missing name"),
        (GOOD[:-5], "missing name"),
        ("", "missing name"),
        (None, "missing name"),
        (GOOD.replace('"ALP"', "null"), "missing name"),
        (GOOD.replace(",\"time_stamp\":1715089953", ""), "missing time"),
        (GOOD.replace("1715089953", "1715089953749"), "time range"),
        (GOOD.replace("1715089953", "12"), "time range"),
    ],
)
def test_reject_reasons(spark, message, reason):
    df = parse(spark, message).select(reject_reason().alias("reason"))
    assert df.first().reason == reason


def test_split(spark):
    good, bad = split(parse(spark, GOOD, "junk", GOOD), reject_reason())
    assert good.count() == 2
    assert [r.reject_reason for r in bad.collect()] == ["missing name"]


def test_round_trip(spark):
    money = {name: Decimal(f"{i}.000000000000000001") for i, name in enumerate(TICK.fieldNames(), 7)}
    tick = ("Alpha", "ALP", "u1", money["volume"], money["market_cap"], money["price"], money["price_old"], -1.25,
            money["total_24_volume"], Decimal("12345678901234567890.5"), datetime(2024, 5, 7, 13, 52, 33))
    df = spark.createDataFrame([tick], TICK)
    messages = to_messages(df)
    assert messages.columns == ["key", "value"]
    assert messages.first().key == "u1"
    assert rows(parse_ticks(messages)) == rows(df)


def test_kafka_adapters_say_what_is_missing(spark):
    from tickbars.sinks.messages import publish_to_topic
    from tickbars.sources.ticks import read_topic_stream

    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic_stream(spark, "localhost:1", options={"startingOffsets": "earliest"})
    with pytest.raises(Exception, match="(?i)kafka"):
        publish_to_topic(parse(spark, GOOD), "localhost:1")


def test_formatting(spark):
    from tickbars.functions.formatting import with_formatted

    df = spark.createDataFrame([(1234567.891, 0.5), (2.0, 1e-13)], "a double, b double")
    two = with_formatted(df, ["a"]).orderBy("a")
    assert [r.a_formatted for r in two.collect()] == ["2.00", "1,234,567.89"]
    twelve = with_formatted(df, ["a", "b"], digits=12).orderBy("a")
    assert [(r.a_formatted, r.b_formatted) for r in twelve.collect()] == [("2", "0"), ("1234567.891", "0.5")]
