"""The Kafka and Cassandra adapters, end to end against stand-in data sources that record what reaches them."""

import json
import os
import threading
import time
import uuid
from datetime import datetime
from decimal import Decimal

import pytest
from compare import rows
from pyspark.sql.datasource import (
    DataSource,
    DataSourceWriter,
    SimpleDataSourceStreamReader,
    WriterCommitMessage,
)

from tickbars import schemas
from tickbars.plans import jobs
from tickbars.schemas import TICK
from tickbars.sinks import external
from tickbars.sinks import messages as message_sink
from tickbars.sinks.keyed import KeyedTable
from tickbars.sources import ticks as tick_source
from tickbars.sources.ticks import read_message_files_stream
from tickbars.streaming import landing, queries

def tick_text(i):
    return json.dumps(
        dict(name_coin=f"coin {i % 12}", symbol_coin=f"S{i % 12}", id=f"u{i % 12}", volume=i, market_cap=2 * i,
             price=10 + i, price_old=10, percent_change_24hr=0.5, total_24_volume=1000, total_market_cap=4000,
             time_stamp=1704103200 + 15 * i)
    )


def stand_in(spark, monkeypatch, folder, messages=()):
    """Put a recording store and topic in place of the real ones; local classes go to Spark's workers by value."""
    texts = [m.encode() for m in messages]
    suffix = uuid.uuid4().hex

    class Recorder(DataSourceWriter):
        def __init__(self, options):
            self.options = dict(options)

        def write(self, iterator):
            import json
            import uuid

            got = [{k: v.decode() if isinstance(v, (bytes, bytearray)) else str(v) for k, v in row.asDict().items()}
                   for row in iterator]
            if got:
                with open(f"{folder}/{uuid.uuid4().hex}.json", "w") as file:
                    json.dump({"options": self.options, "rows": got}, file)
            return WriterCommitMessage()

    class Topic(SimpleDataSourceStreamReader):
        """All messages in the first read; fails once the file ``fail`` is there."""

        def initialOffset(self):
            return {"n": 0}

        def read(self, start):
            import os

            if os.path.exists(f"{folder}/fail"):
                raise RuntimeError("topic is away")
            return self.readBetweenOffsets(start, {"n": len(texts)}), {"n": len(texts)}

        def readBetweenOffsets(self, start, end):
            return iter([(b"key", text) for text in texts[start["n"] : end["n"]]])

        def commit(self, end):
            pass

    class Store(DataSource):
        @classmethod
        def name(cls):
            return f"store_{suffix}"

        def schema(self):
            return "key string"

        def writer(self, schema, overwrite):
            return Recorder(self.options)

    class Broker(Store):
        @classmethod
        def name(cls):
            return f"topic_{suffix}"

        def schema(self):
            return "key binary, value binary"

        def simpleStreamReader(self, schema):
            return Topic()

    spark.dataSource.register(Store)
    spark.dataSource.register(Broker)
    monkeypatch.setattr(external, "STORE_FORMAT", Store.name())
    monkeypatch.setattr(message_sink, "TOPIC_FORMAT", Broker.name())
    monkeypatch.setattr(tick_source, "TOPIC_FORMAT", Broker.name())


def recorded(folder):
    files = [json.load(open(f"{folder}/{name}")) for name in os.listdir(folder) if name.endswith(".json")]
    return [f["options"] for f in files], [row for f in files for row in f["rows"]]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "recorded").mkdir()
    return str(tmp_path / "recorded")


def test_batch_job_into_the_store(spark, tmp_path, folder, monkeypatch):
    stand_in(spark, monkeypatch, folder)
    (tmp_path / "q.csv").write_text("name1,price,marketCap\nAlpha,2.0,10\nAlpha,4.0,5\n")
    out = str(tmp_path / "out")
    jobs.main(["summary", "--input", str(tmp_path / "q.csv"), "--output", out, "--run", "1", "--store", "cassandra"])
    options, got = recorded(folder)
    assert {(o["keyspace"], o["table"]) for o in options} == {("crypto_batch", "crypto_summary")}
    assert got == [{"name": "Alpha", "avg_price": "3.0", "min_price": "2.0", "max_price": "4.0", "max_market_cap": "10.0"}]


def test_stream_into_the_store_leaves_out_unknown_keys(spark, tmp_path, folder, monkeypatch):
    from tickbars.session import streaming_session

    session = streaming_session(spark, state_partitions=2)
    stand_in(session, monkeypatch, folder)
    source = str(tmp_path / "in")
    unknown = tick_text(3).replace('"price_old": 10', '"price_old": 0')
    data = [("k", tick_text(1)), ("k", tick_text(2)), ("k", unknown)]
    spark.createDataFrame(data, "key string, value string").write.parquet(source)
    ticks = landing.accepted_ticks(read_message_files_stream(session, source))
    _, query = queries.start_query("top_winners", ticks, str(tmp_path), store="cassandra", availableNow=True)
    queries.await_all([query])
    options, got = recorded(folder)
    assert {(o["keyspace"], o["table"]) for o in options} == {("crypto", "biggest_winners")}
    assert sorted(row["name_coin"] for row in got) == ["coin 1", "coin 2"]


def test_publish(spark, folder, monkeypatch):
    stand_in(spark, monkeypatch, folder)
    one = Decimal(1)
    tick = ("Alpha", "ALP", "u1", one, one, one, one, 0.5, one, one, datetime(2024, 5, 7, 13, 52, 33))
    message_sink.publish_to_topic(spark.createDataFrame([tick], TICK), "host:9092")
    (options,), (row,) = recorded(folder)
    assert (options["kafka.bootstrap.servers"], options["topic"], options["kafka.acks"]) == ("host:9092", "crypto", "all")
    assert row["key"] == "u1"
    assert json.loads(row["value"])["time_stamp"] == 1715089953


@pytest.mark.parametrize("kept", [False, True])
def test_the_stream_job_from_topic_to_tables(spark, tmp_path, folder, monkeypatch, kept):
    """Landing, five queries, and the end of all of them when the topic fails; plain, and with late ticks and boards kept."""
    from tickbars.session import streaming_session

    count = 60
    session = streaming_session(spark, state_partitions=2)
    stand_in(session, monkeypatch, folder, [tick_text(i) for i in range(count)] + ["junk"])
    monkeypatch.setattr(jobs, "streaming_session", lambda *_, **__: session)
    out = str(tmp_path / "out")
    failures = []

    def job():
        try:
            jobs.tick_stream(spark, "host:9092", "crypto", out, interval="1 second", keep_late=kept, kept_boards=kept)
        except Exception as error:
            failures.append(str(error))

    thread = threading.Thread(target=job)
    thread.start()
    contracts = {c.name: c for c in (schemas.REALTIME_PRICES, schemas.ROLLING_MEANS, schemas.MARKET_SHARE,
                                     schemas.BIGGEST_WINNERS, schemas.BIGGEST_LOSERS)}

    def filled():
        return all(os.path.exists(f"{out}/{name}/log/batch_id=0/_SUCCESS") for name in contracts)

    deadline = time.time() + 120
    while not filled() and time.time() < deadline and thread.is_alive():
        time.sleep(0.5)
    open(f"{folder}/fail", "w").close()
    thread.join(60)
    assert not thread.is_alive()
    assert len(failures) == 1 and "topic is away" in failures[0]
    assert session.streams.active == []

    stored = {name: KeyedTable.open(spark, c, f"{out}/{name}") for name, c in contracts.items()}
    assert stored["crypto_realtime_prices"].latest(spark).count() == count
    winners = stored["biggest_winners"].last_snapshot(spark).orderBy("percent_change", ascending=False).collect()
    assert [r.name_coin for r in winners] == [f"coin {i}" for i in range(11, 1, -1)]
    assert stored["market_share"].last_snapshot(spark).count() == 10
    assert rows(landing.read_quarantine(spark, f"{out}/ticks")) == [("junk", "missing name")]
