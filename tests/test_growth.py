"""What grows with the tables: bytes shuffled by roll-ups in runs, state of streamed totals, files of a batch."""

import os
from types import SimpleNamespace

from compare import plan, rows
from pyspark.sql import functions as F

from tickbars.operators import live, rollups
from tickbars.plans import registry, tables
from tickbars.schemas import ResultTable
from tickbars.session import streaming_session
from tickbars.streaming import landing, queries


def lines(spark, folder, n=600):
    """Few assets and days, so that many lines are of one day; nulls and repeated lines among them."""
    i = F.col("id")
    found = spark.range(0, n, 1, 3).select(
        (i % 90).alias("l_orderkey"),
        (i % 4).cast("int").alias("l_linenumber"),
        F.when(i % 11 != 0, i % 7).alias("l_suppkey"),
        F.when(i % 13 != 0, F.chr(65 + i % 3)).alias("l_returnflag"),
        F.when(i % 17 != 0, F.expr("timestamp_ntz'1998-01-30 05:00:00' + make_dt_interval(int(id % 5), int(id % 24))")).alias("l_shipdate"),
        F.when(i % 19 != 0, (i * 37 % 101).cast("double")).alias("l_extendedprice"),
        (i % 11 / 100).alias("l_discount"),
        (i % 9 / 100).alias("l_tax"),
        (i % 50 + 1).cast("double").alias("l_quantity"),
    )
    found.unionByName(found.where("l_orderkey < 10")).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def events(spark, folder, n=500):
    i = F.col("id")
    spark.range(0, n, 1, 2).select(
        i.alias("event_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, int(id * 7 % 600))").alias("ts"),
        (i % 40).alias("user_id"),
        F.when(i % 2 == 0, "click").otherwise("view").alias("event_type"),
        (i * 13 % 97 + 0.25).alias("value"),
        F.concat(F.lit('{"k": '), i % 100, F.lit("}")).alias("props"),
    ).write.parquet(f"{folder}/events.parquet")
    return folder


def test_daily_bars_shuffle_lines_and_not_the_prices_that_follow(spark, tmp_path):
    folder = lines(spark, str(tmp_path))
    days, position = tables.daily_bars(spark, folder), F.struct("SNo", "Open", "Close")
    wanted = tables.bars(spark, folder).groupBy("Name", "Date").agg(
        F.min("Symbol").alias("Symbol"),
        F.max("High").alias("High"),
        F.min("Low").alias("Low"),
        F.min_by("Open", position).alias("Open"),
        F.max_by("Close", position).alias("Close"),
        F.sum("Volume").alias("Volume"),
        F.round(F.sum("Marketcap"), 2).alias("Marketcap"),
    )
    assert rows(days) == rows(wanted.withColumn("SNo", F.unix_date("Date")).select(*days.columns))
    text = plan(tables.daily_bars(spark, folder))
    assert text.count("Exchange") == 1 and "Aggregate" not in text[text.index("Exchange") :]


def test_runs_read_the_lines_of_each_run_once(spark, tmp_path, monkeypatch):
    asked, daily = [], tables.daily_bars

    def counted(*args):
        days = daily(*args)
        where = type(days).where
        monkeypatch.setattr(type(days), "where", lambda df, condition: (asked.append(1) if df is days else None, where(df, condition))[1])
        return days

    monkeypatch.setattr(tables, "daily_bars", counted)
    folder = lines(spark, str(tmp_path))
    months, years = registry._rollups_in_runs(spark, folder)
    assert len(asked) == 3
    days = daily(spark, folder)
    assert rows(months.last_snapshot(spark).drop("snapshot_id")) == rows(rollups.bars_by_month(days))
    assert rows(years.last_snapshot(spark).drop("snapshot_id")) == rows(rollups.bars_by_year(days))


def test_years_of_merged_partials_need_no_shuffle_of_their_own(spark, tmp_path):
    path = str(tmp_path / "partials")
    rollups.period_partials(tables.daily_bars(spark, lines(spark, str(tmp_path))), "month", unique_sequence=True).write.parquet(path)
    months = rollups.merged_partials(spark.read.parquet(path))
    years = rollups.year_base_from_months(months)
    assert plan(years).count("Exchange") == 1
    months.persist()
    try:
        months.count()
        above = plan(rollups.year_base_from_months(months)).split("InMemoryTableScan")[0]
        assert "Exchange" not in above
    finally:
        months.unpersist()


def test_rows_without_a_repeated_key_are_the_newest_as_they_are(spark):
    df = spark.range(0, 300, 1, 3).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), (F.col("id") % 2).alias("t"), "id")
    found = live.newest_per_key(df, ["k"], "t")
    assert "Join" not in plan(found) and "Exchange" not in plan(found) and rows(found) == rows(df)
    twice = live.newest_per_key(df.unionByName(df.where("id in (0, 7)").withColumn("t", F.lit(9))), ["k"], "t")
    assert rows(twice.where("t = 9").select("id")) == [(0,), (7,)] and twice.count() == 300


def test_a_stream_keeps_no_columns_that_its_table_lacks(spark, tmp_path):
    folder = events(spark, str(tmp_path))
    _, root, messages = registry._message_stream(spark, folder, "narrow")
    totals = queries.totals_stream(landing.accepted_ticks(messages))
    contract, seen = ResultTable("narrow", ("id", "total_24_volume"), ("id",), "s"), []

    def write(df, _):
        seen.append(df.columns)
        df.count()

    table = SimpleNamespace(contract=contract, checkpoint=f"{root}/checkpoint", write_batch=write)
    queries.await_all([queries.upsert_stream(totals, table, "append", availableNow=True)])
    assert seen and all(columns == ["id", "total_24_volume"] for columns in seen)


def test_rocksdb_rows_are_not_counted(spark):
    session = streaming_session(spark, rocksdb=True)
    assert session.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows") == "false"


def test_every_batch_has_files_for_all_cores(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    _, root, messages = registry._message_stream(spark, events(spark, str(tmp_path)), "files", batches=4)
    assert sum(name.endswith(".parquet") for name in os.listdir(f"{root}/messages")) == 4 * cores
    sizes = []
    writer = messages.writeStream.foreachBatch(lambda batch, _: sizes.append(batch.count()))
    queries.await_all([writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()])
    assert len(sizes) == 4 and min(sizes) > 0 and sum(sizes) == 500
