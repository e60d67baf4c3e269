"""Windows through panes on a stream, late ticks, and totals joined on a stream."""

import math
import os

import pytest
from compare import rows
from pyspark.sql import functions as F
from test_streaming import land, land_in, message, sample

from tickbars import schemas
from tickbars.functions.messages import parse_ticks
from tickbars.operators import live
from tickbars.operators.rolling import rolling_stats, rolling_stats_from_panes
from tickbars.session import streaming_session
from tickbars.sinks.keyed import KeyedTable
from tickbars.sources.ticks import read_message_files, read_message_files_stream
from tickbars.streaming import landing, lateness, queries

FLUSH = message("flush", "23:59:00")
STATS = ("arithmetic_mean", "geometric_mean", "standard_deviation")


@pytest.fixture
def session(spark):
    return streaming_session(spark, state_partitions=2)


def start(session, name, folder, root):
    messages = read_message_files_stream(session, folder, files_per_batch=1)
    table, query = queries.start_query(name, landing.accepted_ticks(messages), root, availableNow=True)
    queries.await_all([query])
    return table, query


def windows(df):
    return {(r.symbol_coin, r.start_time): tuple(r[name] for name in STATS) for r in df.collect()}


def same(found, wanted):
    assert found.keys() == wanted.keys()
    for key, values in wanted.items():
        for a, b in zip(found[key], values, strict=True):
            assert (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)), key


@pytest.mark.parametrize("files", [1, 4])
def test_panes_on_a_stream_equal_windows(spark, session, tmp_path, files):
    folder = str(tmp_path / "in")
    land_in(spark, folder, sample(), files)
    ticks = parse_ticks(read_message_files(spark, folder))
    wanted = windows(rolling_stats(ticks))
    land(spark, folder, FLUSH)
    table, query = start(session, "rolling_stats_panes", folder, str(tmp_path))
    same(windows(table.latest(spark)), wanted)
    # Append mode: each window once, over all batches.
    assert table.log(spark).count() == len(wanted)


def test_open_panes_are_a_fraction_of_open_windows(spark, session, tmp_path):
    folder = str(tmp_path / "in")
    land_in(spark, folder, sample(), 3)
    _, direct = start(session, "rolling_stats", folder, str(tmp_path / "a"))
    _, panes = start(session, "rolling_stats_panes", folder, str(tmp_path / "b"))
    most = lambda query, i: max(p.stateOperators[i].numRowsTotal for p in query.recentProgress)
    states = {op.operatorName for op in panes.lastProgress.stateOperators}
    assert len(panes.lastProgress.stateOperators) == 2 and states == {"stateStoreSave"}
    assert min(most(panes, 0), most(panes, 1)) * 3 <= most(direct, 0)
    assert most(panes, 0) + most(panes, 1) < most(direct, 0)


def test_panes_go_on_after_a_restart(spark, session, tmp_path):
    folder = str(tmp_path / "in")
    land_in(spark, folder, sample()[:60], 2)
    start(session, "rolling_stats_panes", folder, str(tmp_path))
    land_in(spark, folder, sample()[60:], 2)
    ticks = parse_ticks(read_message_files(spark, folder))
    wanted = windows(rolling_stats(ticks))
    land(spark, folder, FLUSH)
    table, _ = start(session, "rolling_stats_panes", folder, str(tmp_path))
    same(windows(table.latest(spark)), wanted)


def test_merged_deviation_keeps_its_digits(spark):
    prices = [1e9 + x * 1e-3 for x in (1, 2, 4, 8, 3, 7)]
    data = [("A", f"2024-01-01 10:00:{10 * i:02}", p) for i, p in enumerate(prices)]
    ticks = spark.createDataFrame(data, "symbol_coin string, t string, price double").withColumn("time_stamp", F.col("t").cast("timestamp"))
    found = rolling_stats_from_panes(ticks, "1 minute", "10 seconds").where("end_time = timestamp'2024-01-01 10:01:00'").first()
    mean = sum(prices) / 6
    assert math.isclose(found.standard_deviation, math.sqrt(sum((p - mean) ** 2 for p in prices) / 5), rel_tol=1e-4)


# Late ticks -----------------------------------------------------------------------------------------------------------

# Batches of (symbol, time); the third batch comes behind 10:20, closed until 10:15.
BATCHES = [
    ["A 10:00:05", "B 10:01:00"],
    ["A 10:20:00"],
    ["A 10:00:25", "B 10:12:40", "B 10:14:59", "A 10:15:00", "A 10:21:00"],
    ["B 10:16:00", "A 10:10:59", "A 10:30:00"],
]


def by_hand():
    """Windows and late ticks of BATCHES, tick by tick, in seconds of the day."""
    mark, kept, late = None, {}, []
    for batch in BATCHES:
        times = []
        for tick in batch:
            symbol, clock = tick.split()
            h, m, s = map(int, clock.split(":"))
            t = h * 3600 + m * 60 + s
            times.append(t)
            ends = [e for e in range(t - t % 30 + 30, t - t % 30 + 331, 30) if t < e <= t - t % 30 + 300]
            missed = [e for e in ends if mark is not None and e <= mark - 300]
            for end in set(ends) - set(missed):
                kept[symbol, end] = kept.get((symbol, end), 0) + 1
            if missed:
                late.append((symbol, clock, len(missed), "late" if len(missed) == len(ends) else "late in part"))
        mark = max(times if mark is None else [mark, *times])
    return kept, sorted(late)


def marked(spark, session, tmp_path, batches=BATCHES):
    folder, landed = str(tmp_path / "in"), str(tmp_path / "landed")
    for batch in batches:
        land(spark, folder, *[message(*tick.split()) for tick in batch])
        messages = read_message_files_stream(session, folder, files_per_batch=1)
        queries.await_all([lateness.land_ticks_marked(messages, landed, str(tmp_path / "checkpoint"), availableNow=True)])
    return landed


def on_time(session, landed, root):
    stats = lateness.rolling_on_time_stream(lateness.read_marked_stream(session, landed))
    counted = stats.select("symbol_coin", "arithmetic_mean", "geometric_mean", "standard_deviation", "start_time", "end_time")
    table = queries.open_table(counted, schemas.ROLLING_MEANS, root, "files")
    query = queries.upsert_stream(counted, table, "update", availableNow=True)
    queries.await_all([query])
    return table, query


def test_late_ticks_are_set_aside_with_their_reason(spark, session, tmp_path):
    landed = marked(spark, session, tmp_path)
    late = lateness.late_ticks(lateness.read_marked(spark, landed))
    shown = late.select("symbol_coin", F.date_format("time_stamp", "HH:mm:ss"), "missed_windows", "reject_reason")
    assert sorted(map(tuple, shown.collect())) == by_hand()[1]


@pytest.mark.parametrize("together", [True, False])
def test_windows_do_not_depend_on_the_querys_batches(spark, session, tmp_path, together):
    """All landed batches in one micro-batch, or each in its own: each tick is where it was in time, and none is lost to
    the query's own watermark."""
    wanted = {key for key in by_hand()[0]}
    if together:
        table, query = on_time(session, marked(spark, session, tmp_path), str(tmp_path))
    else:
        for n in range(1, len(BATCHES) + 1):
            landed = marked(spark, session, tmp_path, BATCHES[n - 1 : n])
            table, query = on_time(session, landed, str(tmp_path))
    found = {(r.symbol_coin, (r.end_time.hour * 60 + r.end_time.minute) * 60 + r.end_time.second) for r in table.latest(spark).collect()}
    assert found == wanted
    assert sum(p.stateOperators[0].numRowsDroppedByWatermark for p in query.recentProgress if p.stateOperators) == 0


def test_a_stream_may_start_before_the_first_batch_lands(spark, session, tmp_path):
    landed = marked(spark, session, tmp_path, [])
    lateness.make_folder(session, f"{landed}/_marks")
    ticks = lateness.read_marked_stream(session, landed)
    writer = ticks.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
    query = writer.trigger(processingTime="0 seconds").start()
    try:
        marked(spark, session, tmp_path, BATCHES[:2])
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(lateness.read_marked(spark, landed))


def test_a_landed_batch_is_left_alone_when_repeated(spark, session, tmp_path):
    landed = marked(spark, session, tmp_path, BATCHES[:2])
    files = sorted(os.path.join(d, f) for d, _, names in os.walk(landed) for f in names if f.endswith(".parquet"))
    # The second batch's commit is lost, as when the driver ends before it is written down.
    for name in ("1", ".1.crc"):
        os.remove(tmp_path / "checkpoint" / "commits" / name)
    messages = read_message_files_stream(session, str(tmp_path / "in"), files_per_batch=1)
    queries.await_all([lateness.land_ticks_marked(messages, landed, str(tmp_path / "checkpoint"), availableNow=True)])
    assert files == sorted(os.path.join(d, f) for d, _, names in os.walk(landed) for f in names if f.endswith(".parquet"))
    assert lateness.read_marked(spark, landed).count() == 3


def test_an_unfinished_batch_is_landed_again(spark, session, tmp_path):
    landed = marked(spark, session, tmp_path, BATCHES[:1])
    # What a driver leaves that ends in the middle of the second batch.
    (tmp_path / "landed" / "_staged-1" / "rejected=false").mkdir(parents=True)
    (tmp_path / "landed" / "_staged-1" / "rejected=false" / "part-0.parquet").write_text("unfinished")
    (tmp_path / "landed" / "_marks" / "1=5").write_text("")
    marked(spark, session, tmp_path, BATCHES[1:2])
    assert lateness.read_marked(spark, landed).count() == 3
    (mark,) = [p.name for p in (tmp_path / "landed" / "_marks").iterdir() if p.name.startswith("1=")]
    assert mark != "1=5"


def test_rejected_messages_have_no_mark(spark, session, tmp_path):
    far = message("A", "10:00:00").replace('"time_stamp": 17', '"time_stamp": 9917')
    folder, landed = str(tmp_path / "in"), str(tmp_path / "landed")
    for text in (far, message("A", "10:00:00"), message("B", "10:00:30")):
        land(spark, folder, text)
    messages = read_message_files_stream(session, folder, files_per_batch=1)
    queries.await_all([lateness.land_ticks_marked(messages, landed, str(tmp_path / "checkpoint"), availableNow=True)])
    found = {r.symbol_coin: r.high_water for r in lateness.read_marked(spark, landed).collect()}
    assert found["A"] is None and found["B"].isoformat() == "2024-01-01T10:00:00"


# Totals ---------------------------------------------------------------------------------------------------------------


def test_totals_of_a_stream_equal_those_of_the_table(spark, session, tmp_path):
    folder = str(tmp_path / "in")
    land_in(spark, folder, sample(), 3)
    ticks = parse_ticks(read_message_files(spark, folder))
    wanted = live.with_window_totals(ticks, "10 minutes").select("id", "time_stamp", "total_24_volume", "total_market_cap")
    wanted = rows(wanted)
    land(spark, folder, FLUSH)
    messages = read_message_files_stream(session, folder, files_per_batch=1)
    stream = queries.totals_stream(landing.accepted_ticks(messages), "10 minutes")
    contract = schemas.ResultTable("totals", ("id", "time_stamp", "total_24_volume", "total_market_cap"), ("id", "time_stamp"), "t")
    table = KeyedTable.like(stream, contract, str(tmp_path / "totals"))
    query = queries.upsert_stream(stream, table, "append", availableNow=True)
    queries.await_all([query])
    assert rows(table.latest(spark)) == wanted
    # State of closed windows is gone: what is left belongs to the last tick.
    assert max(op.numRowsTotal for op in query.lastProgress.stateOperators) <= 2
