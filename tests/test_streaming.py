import json
import math
import os
from datetime import datetime, timezone
from random import Random

import pytest
from compare import rows

from tickbars.functions.messages import parse_ticks
from tickbars.operators import boards, live, lookups
from tickbars.operators.rolling import rolling_stats
from tickbars.session import streaming_session
from tickbars.sources.ticks import read_message_files, read_message_files_stream
from tickbars.streaming import landing, queries

DAY = "2024-01-01"


@pytest.fixture
def session(spark):
    return streaming_session(spark, state_partitions=2)


def message(symbol, clock, price=10.0, old=8.0):
    seconds = int(datetime.fromisoformat(f"{DAY} {clock}").replace(tzinfo=timezone.utc).timestamp())
    fields = dict(name_coin=f"coin {symbol}", symbol_coin=symbol, id=symbol, volume=price * 2, market_cap=price * 3,
                  price=price, price_old=old, percent_change_24hr=0.5, total_24_volume=1000, total_market_cap=4000,
                  time_stamp=seconds)
    return json.dumps(fields)


_clock = [1_700_000_000]


def land(spark, folder, *messages):
    """Add one file of messages; files are processed oldest first."""
    df = spark.createDataFrame([("k", m) for m in messages], "key string, value string").coalesce(1)
    df.write.mode("append").parquet(folder)
    files = [os.path.join(folder, name) for name in os.listdir(folder) if name.endswith(".parquet")]
    newest = max(files, key=os.path.getctime)
    _clock[0] += 10
    os.utime(newest, (_clock[0], _clock[0]))


def run(session, name, folder, root, files_per_batch=1):
    messages = read_message_files_stream(session, folder, files_per_batch=files_per_batch)
    table, query = queries.start_query(name, landing.accepted_ticks(messages), root, availableNow=True)
    queries.await_all([query])
    return table, query


def sample(n=120):
    """Ticks in time order."""
    return [message("ABC"[i % 3], f"10:{i // 4:02}:{(i % 4) * 15:02}", 10 + (i * 7) % 11, (i % 5) * 3) for i in range(n)]


def land_in(spark, folder, messages, files):
    size = math.ceil(len(messages) / files)
    for i in range(0, len(messages), size):
        land(spark, folder, *messages[i : i + size])


@pytest.mark.parametrize(("files", "rocksdb"), [(1, False), (4, False), (4, True)])
def test_stream_equals_batch(spark, tmp_path, files, rocksdb):
    session = streaming_session(spark, state_partitions=2, rocksdb=rocksdb)
    folder = str(tmp_path / "in")
    land_in(spark, folder, sample(), files)
    ticks = parse_ticks(read_message_files(spark, folder))
    metrics = live.with_metrics(ticks)

    table, query = run(session, "live_prices", folder, str(tmp_path))
    assert len([p for p in query.recentProgress if p.numInputRows]) == files
    prices = live.live_prices(ticks).select(*table.contract.columns)
    assert rows(table.latest(spark)) == rows(prices)

    table, _ = run(session, "rolling_stats", folder, str(tmp_path))
    want = {(r.symbol_coin, r.end_time): r for r in rolling_stats(ticks).collect()}
    got = {(r.symbol_coin, r.end_time): r for r in table.latest(spark).collect()}
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key].arithmetic_mean == row.arithmetic_mean
        assert math.isclose(got[key].geometric_mean, row.geometric_mean)
        if row.standard_deviation is None:
            assert got[key].standard_deviation is None
        else:
            assert math.isclose(got[key].standard_deviation, row.standard_deviation, abs_tol=1e-9)

    for name, board, view in (
        ("top_winners", boards.top_winners(metrics, 10), lookups.winners_view),
        ("top_losers", boards.top_losers(metrics, 10), lookups.losers_view),
        ("market_share", boards.market_share(metrics, 10), lookups.share_view),
    ):
        table, _ = run(session, name, folder, str(tmp_path))
        last = view(table.last_snapshot(spark)).drop("snapshot_id")
        assert [tuple(r) for r in last.collect()] == [tuple(r) for r in board.select(*last.columns).collect()]


def test_disorder_within_the_watermark_loses_nothing(spark, session, tmp_path):
    folder = str(tmp_path / "in")
    messages = sample()
    random = Random(3)
    order = sorted(range(len(messages)), key=lambda i: i + random.random() * 15)  # up to 225 of 300 seconds late
    land_in(spark, folder, [messages[i] for i in order], 6)
    table, query = run(session, "rolling_stats", folder, str(tmp_path))
    assert sum(p.stateOperators[0].numRowsDroppedByWatermark for p in query.recentProgress) == 0
    keys = ["symbol_coin", "end_time", "arithmetic_mean"]
    ticks = parse_ticks(read_message_files(spark, folder))
    assert rows(table.latest(spark).select(*keys)) == rows(rolling_stats(ticks).select(*keys))


def test_update_mode_emits_changed_windows_again(spark, session, tmp_path):
    folder = str(tmp_path / "in")
    land(spark, folder, message("A", "10:00:05", 1.0), message("B", "10:00:06", 5.0))
    land(spark, folder, message("A", "10:00:07", 3.0))
    table, _ = run(session, "rolling_stats", folder, str(tmp_path))
    log = table.log(spark)
    assert log.groupBy("batch_id").count().orderBy("batch_id").collect()[:2] == [(0, 20), (1, 10)]
    means = {(r.symbol_coin, r.arithmetic_mean) for r in table.latest(spark).collect()}
    assert means == {("A", 2.0), ("B", 5.0)}


def test_late_ticks_are_dropped_and_counted(spark, session, tmp_path):
    folder = str(tmp_path / "in")
    for group in (["A 10:00:05"], ["B 10:20:00"], ["B 10:20:10"], ["A 10:00:25", "A 10:15:30"]):
        land(spark, folder, *[message(*tick.split()) for tick in group])
    table, query = run(session, "rolling_stats", folder, str(tmp_path))
    progress = [p for p in query.recentProgress if p.numInputRows]
    assert len(progress) == 4
    # Dropped after the tick was expanded to its ten windows.
    assert progress[-1].stateOperators[0].numRowsDroppedByWatermark == 10
    ends = {r.end_time.strftime("%H:%M:%S") for r in table.latest(spark).where("symbol_coin = 'A'").collect()}
    assert "10:15:00" not in ends and "10:15:30" not in ends and "10:16:00" in ends
    assert len(ends) == 10 + 10


def test_restart_continues_and_a_repeated_batch_replaces_itself(spark, session, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path)
    messages = sample(60)
    land_in(spark, folder, messages[:30], 2)
    table, _ = run(session, "rolling_stats", folder, root)
    before = rows(table.latest(spark))
    run(session, "rolling_stats", folder, root)
    assert rows(table.latest(spark)) == before

    land_in(spark, folder, messages[30:], 1)
    run(session, "rolling_stats", folder, root)
    ticks = parse_ticks(read_message_files(spark, folder))
    keys = ["symbol_coin", "end_time", "arithmetic_mean"]
    assert rows(table.latest(spark).select(*keys)) == rows(rolling_stats(ticks).select(*keys))

    # The last batch once more, as after a crash between its write and its entry in the checkpoint.
    complete = rows(table.latest(spark))
    commits = f"{table.checkpoint}/commits"
    last = max(int(name) for name in os.listdir(commits) if name.isdigit())
    os.remove(f"{commits}/{last}")
    checksum = f"{commits}/.{last}.crc"
    if os.path.exists(checksum):
        os.remove(checksum)
    run(session, "rolling_stats", folder, root)
    assert rows(table.latest(spark)) == complete


def test_landing_keeps_rejected_messages_apart(spark, session, tmp_path):
    folder, landed = str(tmp_path / "in"), str(tmp_path / "landed")
    land(spark, folder, message("A", "10:00:00"), "junk")
    land(spark, folder, message("B", "10:00:01"), '{"name_coin":"x","symbol_coin":"y"}')
    messages = read_message_files_stream(session, folder, files_per_batch=1)
    for _ in range(2):
        queries.await_all([landing.land_ticks(messages, landed, str(tmp_path / "cp"), availableNow=True)])
    assert rows(landing.read_landed(spark, landed).select("symbol_coin")) == [("A",), ("B",)]
    assert rows(landing.read_quarantine(spark, landed)) == [
        ("junk", "missing name"),
        ('{"name_coin":"x","symbol_coin":"y"}', "missing time"),
    ]


def test_all_queries_follow_one_landing_started_beside_them(spark, session, tmp_path):
    """The queries may start before the first tick is landed; later runs pick up where they were."""
    folder, landed, root = str(tmp_path / "in"), str(tmp_path / "landed"), str(tmp_path / "out")
    messages = sample(40)
    for part in (messages[:20], messages[20:]):
        land(spark, folder, *part)
        source = read_message_files_stream(session, folder)
        queries.await_all([landing.land_ticks(source, landed, str(tmp_path / "cp"), availableNow=True)])
        started = queries.start_all(landing.read_landed_stream(session, landed), root, availableNow=True)
        queries.await_all([query for _, query in started.values()])
    assert set(started) == {"live_prices", "rolling_stats", "top_winners", "top_losers", "market_share"}
    assert started["live_prices"][0].latest(spark).count() == 40
    assert started["top_winners"][0].last_snapshot(spark).first().snapshot_id == 1
    history = lookups.price_history(started["live_prices"][0].latest(spark), "A", f"{DAY} 10:01:00", f"{DAY} 10:05:00")
    times = [r.time_stamp for r in history.collect()]
    assert times == sorted(times, reverse=True) and len(times) == 5
    windows = lookups.rolling_history(started["rolling_stats"][0].latest(spark), "B")
    ends = [r.end_time for r in windows.collect()]
    assert ends == sorted(ends, reverse=True) and len(set(ends)) == len(ends)


def test_queries_can_start_on_an_empty_landing_folder(spark, session, tmp_path):
    landed = str(tmp_path / "landed")
    folder = str(tmp_path / "in")
    os.mkdir(folder)
    source = read_message_files_stream(session, folder)
    first = landing.land_ticks(source, landed, str(tmp_path / "cp"), availableNow=True)
    table, query = queries.start_query(
        "live_prices", landing.read_landed_stream(session, landed), str(tmp_path), availableNow=True
    )
    queries.await_all([first, query])
    assert table.latest(spark).count() == 0


def test_a_failing_query_stops_the_others_and_is_raised(spark, session, tmp_path):
    folder = str(tmp_path / "in")
    land(spark, folder, *sample(4))
    ticks = landing.accepted_ticks(read_message_files_stream(session, folder))
    _, healthy = queries.start_query("live_prices", ticks, str(tmp_path))

    def fail(_batch, _batch_id):
        raise RuntimeError("store is away")

    broken = ticks.writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "broken")).start()
    with pytest.raises(Exception, match="store is away"):
        queries.await_any(session, [healthy, broken])
    assert not healthy.isActive and not broken.isActive


def test_console_preview(spark, session, tmp_path):
    from tickbars.sinks.external import preview_stream

    folder = str(tmp_path / "in")
    land(spark, folder, message("A", "10:00:00"))
    query = preview_stream(landing.accepted_ticks(read_message_files_stream(session, folder)), str(tmp_path / "cp"))
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None
    assert sum(p.numInputRows for p in query.recentProgress) == 1


def test_unknown_store(session, tmp_path, spark):
    folder = str(tmp_path / "in")
    land(spark, folder, *sample(1))
    ticks = landing.accepted_ticks(read_message_files_stream(session, folder))
    with pytest.raises(ValueError, match="store"):
        queries.start_query("live_prices", ticks, str(tmp_path), store="tape")


def test_session_settings_do_not_reach_the_caller(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    other = streaming_session(spark, state_partitions=3, rocksdb=True)
    assert other.conf.get("spark.sql.shuffle.partitions") == "3"
    assert "RocksDB" in other.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
