import copy
import json
from datetime import datetime
from decimal import Decimal

import pytest
from compare import plan, rows

from tickbars.schemas import TICK
from tickbars.sources.payloads import payload_rejects, payload_ticks, read_payloads

COIN = {
    "uuid": "u1",
    "symbol": "ALP",
    "name": "Alpha",
    "24hVolume": "1234567890.5",
    "marketCap": "99999999999999999.123456789012345678",
    "price": "2.5",
    "change": "-1.5",
    "sparkline": ["2.25", "2.4", "2.5"],
}
STATS = {"total24hVolume": "5000000000", "totalMarketCap": 123456789.5}


def land(spark, tmp_path, *coins, stats=STATS, raw=None):
    body = raw if raw is not None else json.dumps({"status": "success", "data": {"stats": stats, "coins": list(coins)}})
    (tmp_path / "p.json").write_text(json.dumps({"fetched_at": 1715089953, "body": body}) + "\n")
    return read_payloads(spark, str(tmp_path / "p.json"))


def coin(**changes):
    value = copy.deepcopy(COIN)
    for key, change in changes.items():
        key = {"volume": "24hVolume"}.get(key, key)
        if change is ...:
            del value[key]
        else:
            value[key] = change
    return value


def test_fields(spark, tmp_path):
    ticks = payload_ticks(land(spark, tmp_path, COIN))
    assert [(f.name, f.dataType) for f in ticks.schema] == [(f.name, f.dataType) for f in TICK]
    row = ticks.first()
    assert row.market_cap == Decimal("99999999999999999.123456789012345678")
    assert (row.volume, row.price, row.price_old) == (Decimal("1234567890.5"), Decimal("2.5"), Decimal("2.25"))
    assert (row.total_24_volume, row.total_market_cap) == (Decimal(5000000000), Decimal("123456789.5"))
    assert (row.percent_change_24hr, row.time_stamp) == (-1.5, datetime(2024, 5, 7, 13, 52, 33))


@pytest.mark.parametrize(
    ("sparkline", "old"),
    [([], "2.5"), (["7"], "2.5"), (["7", "8"], "7"), ([7, None], "7"), ([1e-7, 2], "0.0000001")],
)
def test_old_price(spark, tmp_path, sparkline, old):
    assert payload_ticks(land(spark, tmp_path, coin(sparkline=sparkline))).first().price_old == Decimal(old)


@pytest.mark.parametrize(
    "bad",
    [
        coin(volume=None),
        coin(price="n/a"),
        coin(name=...),
        coin(uuid=None),
        coin(change=""),
        coin(sparkline=None),
        coin(sparkline=[None, "2"]),
    ],
)
def test_a_bad_coin_is_set_aside_and_the_others_go_on(spark, tmp_path, bad):
    payloads = land(spark, tmp_path, coin(uuid="before"), bad, coin(uuid="after"))
    assert [r.id for r in payload_ticks(payloads).collect()] == ["before", "after"]
    assert payload_rejects(payloads).count() == 1


def test_missing_stats_reject_the_poll(spark, tmp_path):
    payloads = land(spark, tmp_path, COIN, coin(uuid="u2"), stats={})
    assert payload_ticks(payloads).count() == 0
    assert payload_rejects(payloads).count() == 2


@pytest.mark.parametrize("raw", ["junk", "", "{}", '{"data": null}', '{"data": {"coins": []}}'])
def test_documents_without_coins(spark, tmp_path, raw):
    assert payload_ticks(land(spark, tmp_path, raw=raw)).count() == 0


@pytest.mark.parametrize("body", ["not json", "{}", '{"data":{"stats":{},"coins":[]}}', None])
def test_a_document_that_gives_no_coin_is_counted(spark, body):
    documents = spark.createDataFrame([(1_700_000_000, body)], "fetched_at long, body string")
    assert payload_ticks(documents).count() == 0
    assert payload_rejects(documents).count() == 1


def test_a_fetch_time_in_the_wrong_unit_rejects_the_poll(spark):
    body = json.dumps({"data": {"stats": STATS, "coins": [COIN]}})
    for seconds in (1715089953749, 2**62, -5, None):
        payloads = spark.createDataFrame([(seconds, body)], "fetched_at long, body string")
        assert payload_ticks(payloads).count() == 0
        assert payload_rejects(payloads).count() == 1


def test_flattening_shuffles_nothing(spark, tmp_path):
    assert "Exchange" not in plan(payload_ticks(land(spark, tmp_path, COIN)))


def test_table_documents_are_bounded(spark, sf_dir):
    from pyspark.sql import functions as F

    from tickbars.plans import tables

    documents = tables.payloads(spark, sf_dir)
    sizes = documents.select(F.json_array_length(F.get_json_object("body", "$.data.coins")).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= tables.COINS_PER_PAYLOAD
    assert sizes.agg(F.sum("n")).first()[0] == tables.ticks(spark, sf_dir).count()


def test_flat_ticks_survive(spark, sf_dir):
    from tickbars.plans import tables

    documents = tables.payloads(spark, sf_dir)
    assert rows(payload_ticks(documents).select("id")) == rows(tables.ticks(spark, sf_dir).select("id"))
