"""Registered queries over the given tables: ``name -> (spark, sf_dir) -> DataFrame``.

Results are shaped for comparison: decimals as doubles, times zone-less, and values that a different order of additions
may change in their last bits rounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars import schemas
from tickbars.functions.formatting import with_formatted
from tickbars.functions.metrics import percent_change
from tickbars.functions.messages import parse_ticks, reject_reason, to_messages
from tickbars.operators import boards, live, lookups, ranking, rolling, rollups
from tickbars.plans import jobs, tables
from tickbars.session import streaming_session, use_utc, work_dir
from tickbars.sinks import partitioned
from tickbars.sinks.keyed import KeyedTable
from tickbars.sinks.messages import publish_to_files
from tickbars.sources.bars import land_checked_bars, read_bars, read_checked_bars, read_landed_bars, read_rejected_lines
from tickbars.sources.payloads import payload_rejects as rejected_coins
from tickbars.sources.payloads import payload_ticks, read_payloads
from tickbars.sources.ticks import read_message_files, read_message_files_stream
from tickbars.streaming import incremental_boards, landing, lateness, queries as streams

Query = Callable[[SparkSession, str], DataFrame]

BAR_SUMS = ("total_volume", "total_marketcap")
WINDOW_VALUES = ("geometric_mean", "standard_deviation")
RUN = 1
#: Tables of which only the newest batch counts: a board replaces the one before.
BOARDS = ("top_winners", "top_losers", "market_share")


def plain(df: DataFrame, round_to: dict[str, int] | None = None) -> DataFrame:
    """Doubles for decimals, zone-less times, and the named columns rounded."""

    def shaped(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        if round_to and field.name in round_to:
            column = F.round(column, round_to[field.name])
        return column.alias(field.name)

    return df.select(*[shaped(field) for field in df.schema.fields])


def _rounded(columns: Iterable[str], digits: int) -> dict[str, int]:
    return {name: digits for name in columns}


def _bars(df: DataFrame) -> DataFrame:
    return plain(df, _rounded(BAR_SUMS, 2))


def _windows(df: DataFrame) -> DataFrame:
    return plain(df, _rounded(WINDOW_VALUES, 6))


# Bars -----------------------------------------------------------------------------------------------------------------


def bars_by_month(spark, sf_dir):
    return _bars(rollups.bars_by_month(tables.bars(spark, sf_dir)))


def bars_by_year(spark, sf_dir):
    return _bars(rollups.bars_by_year(tables.bars(spark, sf_dir)))


def bars_by_year_from_months(spark, sf_dir):
    months = rollups.period_base(tables.bars(spark, sf_dir), "month")
    return _bars(rollups.labelled(rollups.year_base_from_months(months), "year"))


def daily_bars_by_month(spark, sf_dir):
    return _bars(rollups.bars_by_month(tables.daily_bars(spark, sf_dir), unique_sequence=True))


def daily_bars_by_year(spark, sf_dir):
    return _bars(rollups.bars_by_year(tables.daily_bars(spark, sf_dir), unique_sequence=True))


def month_bar_lookup(spark, sf_dir):
    months = rollups.bars_by_month(tables.bars(spark, sf_dir))
    return _bars(lookups.bar_lookup(months, "S7", "month", "1998-06"))


def year_bar_lookup(spark, sf_dir):
    years = rollups.bars_by_year(tables.bars(spark, sf_dir))
    return _bars(lookups.bar_lookup(years, "S7", "year", "1998"))


def asset_summary(spark, sf_dir):
    return plain(rollups.asset_summary(tables.quotes(spark, sf_dir)))


def formatted_summary(spark, sf_dir):
    summary = rollups.asset_summary(tables.quotes(spark, sf_dir))
    shown = with_formatted(summary, ["min_price", "max_price"])
    return shown.select("name", "min_price_formatted", "max_price_formatted")


def formatted_bars(spark, sf_dir):
    """Month bars with the long number format: up to twelve decimals."""
    months = rollups.bars_by_month(tables.bars(spark, sf_dir))
    shown = with_formatted(months, ["highest_high", "first_open"], digits=12)
    return shown.select("name", "month", "highest_high_formatted", "first_open_formatted")


def top_bars(spark, sf_dir):
    return plain(ranking.top_bars(tables.bars(spark, sf_dir)))


def top_bars_by_volume(spark, sf_dir):
    return plain(ranking.top_bars(tables.bars(spark, sf_dir), by="Volume"))


def top_bars_by_asset(spark, sf_dir):
    return plain(ranking.top_bars_by_asset(tables.bars(spark, sf_dir)))


def top_bars_by_asset_volume(spark, sf_dir):
    """The same by a column of few values, so that most places are shared."""
    return plain(ranking.top_bars_by_asset(tables.bars(spark, sf_dir), by="Volume"))


# Bars that arrive run by run: three runs of landed bars, the second of them twice ------------------------------------


def _rollups_in_runs(spark: SparkSession, sf_dir: str) -> tuple[KeyedTable, KeyedTable]:
    """Years mixed by asset, so that a month's bars come in several runs; run 2 is first landed incomplete."""
    root = work_dir(spark, "runs")
    days, run = tables.daily_bars(spark, sf_dir), F.pmod(F.col("SNo") + F.length("Name"), F.lit(3)) + 1
    for number in (1, 2, 3):
        days.where(run == number).write.parquet(f"{root}/landed/{number}")
    landed = read_landed_bars(spark, f"{root}/landed/2")
    landed.where(F.col("Volume") > 20).write.parquet(f"{root}/landed/2-incomplete")
    found = None
    for number, folder in ((1, "1"), (2, "2-incomplete"), (3, "3"), (2, "2")):
        found = jobs.bar_rollups_of_new(spark, f"{root}/landed/{folder}", root, number, landed=True)
    return found


def bars_by_month_of_runs(spark, sf_dir):
    return _bars(_rollups_in_runs(spark, sf_dir)[0].last_snapshot(spark).drop("snapshot_id"))


def bars_by_year_of_runs(spark, sf_dir):
    return _bars(_rollups_in_runs(spark, sf_dir)[1].last_snapshot(spark).drop("snapshot_id"))


# Bars through CSV files: daily bars written as CSV, header lines included, go through the whole batch job --------------


def _bar_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    path = f"{root}/csv"
    tables.daily_bars(spark, sf_dir).write.option("header", True).csv(path)
    return path


def csv_bars(spark, sf_dir):
    bars = read_bars(spark, _bar_files(spark, sf_dir, work_dir(spark, "bars")))
    return plain(bars)


def _damaged_bar_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Bar lines with one header line, three in seven of them damaged in different ways."""
    path, names = f"{root}/csv", ["SNo", "Name", "Symbol", "Date", "High", "Low", "Open", "Close", "Volume", "Marketcap"]
    fields = [F.col(name).cast("string") for name in names]
    kind = F.pmod(F.col("SNo"), F.lit(7))
    line = (
        F.when(kind == 1, F.concat_ws(",", *fields[:-3]))
        .when(kind == 2, F.concat_ws(",", *fields[:-2], F.lit("many"), fields[-1]))
        .when(kind == 3, F.concat_ws(",", *fields[:-2], F.lit(""), fields[-1]))
        .otherwise(F.concat_ws(",", *fields))
    )
    lines = tables.daily_bars(spark, sf_dir).select(line.alias("value"))
    lines.unionByName(spark.createDataFrame([(",".join(names),)], "value string")).write.text(path)
    return path


def csv_rejects(spark, sf_dir):
    """Damaged bar files landed: the bars, and the rejected lines by their problem."""
    root = work_dir(spark, "rejects")
    landed = f"{root}/landed"
    land_checked_bars(spark, _damaged_bar_files(spark, sf_dir, root), landed)
    bars = read_checked_bars(spark, landed).select(F.lit("none").alias("problem"))
    found = bars.unionByName(read_rejected_lines(spark, landed).select("problem"))
    return found.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


def job_bar_problems(spark, sf_dir):
    """What the roll-up job counts while it reads the same files."""
    root = work_dir(spark, "problems")
    jobs.bar_rollups(spark, _damaged_bar_files(spark, sf_dir, root), root, RUN)
    return jobs.bar_problems(spark, root).last_snapshot(spark).drop("snapshot_id")


def job_month_bars(spark, sf_dir):
    root = work_dir(spark, "months")
    months, _ = jobs.bar_rollups(spark, _bar_files(spark, sf_dir, root), root, RUN)
    return _bars(months.latest(spark))


def job_year_bars(spark, sf_dir):
    root = work_dir(spark, "years")
    _, years = jobs.bar_rollups(spark, _bar_files(spark, sf_dir, root), root, RUN)
    return _bars(years.latest(spark))


def job_asset_summary(spark, sf_dir):
    root = work_dir(spark, "summary")
    quotes = tables.quotes(spark, sf_dir).withColumn("source", F.lit("table"))
    # A further column and another column order: the reader goes by name.
    quotes.select("source", "marketCap", "name1", "price").write.option("header", True).csv(f"{root}/csv")
    return plain(jobs.asset_summary(spark, f"{root}/csv", root, RUN).latest(spark), {"avg_price": 6})


def job_top_bars(spark, sf_dir):
    root = work_dir(spark, "top")
    return plain(jobs.top_bars(spark, _bar_files(spark, sf_dir, root), root, RUN).latest(spark))


# Ticks ----------------------------------------------------------------------------------------------------------------


def _ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.with_daily_totals(tables.ticks(spark, sf_dir))


def tick_metrics(spark, sf_dir):
    return plain(
        live.with_metrics(_ticks(spark, sf_dir)).select(
            "id", "percent_volume", "percent_market_cap", "percent_change", "cir_supply"
        )
    )


def tick_metrics_decimal(spark, sf_dir):
    """The ratios in decimals of the message schema, divided to six decimals."""
    wide = ["volume", "market_cap", "price", "price_old", "total_24_volume", "total_market_cap"]
    ticks = _ticks(spark, sf_dir).withColumns({name: F.col(name).cast("decimal(38,18)") for name in wide})
    return plain(
        live.with_metrics(ticks, "decimal").select(
            "id", "percent_volume", "percent_market_cap", "percent_change", "cir_supply"
        )
    )


def live_prices(spark, sf_dir):
    return plain(live.live_prices(_ticks(spark, sf_dir)))


def snapshot_totals(spark, sf_dir):
    hourly = tables.ticks(spark, sf_dir).withColumn("snapshot", F.date_format("time_stamp", "yyyy-MM-dd HH"))
    return plain(
        live.with_snapshot_totals(hourly, "snapshot").select("id", "total_24_volume", "total_market_cap")
    )


def latest_ticks(spark, sf_dir):
    ticks = tables.ticks(spark, sf_dir).select("symbol_coin", "time_stamp", "id", "name_coin", "price")
    return plain(live.newest_per_key(ticks, ["symbol_coin"], "time_stamp"))


def price_history(spark, sf_dir):
    prices = live.live_prices(_ticks(spark, sf_dir))
    return plain(lookups.price_history(prices, "purchase", "2024-01-08", "2024-01-22"))


def rolling_stats(spark, sf_dir):
    return _windows(rolling.rolling_stats(tables.ticks(spark, sf_dir)))


def rolling_stats_half_hourly(spark, sf_dir):
    return _windows(rolling.rolling_stats(tables.ticks(spark, sf_dir), "6 hours", "30 minutes"))


def rolling_stats_from_panes(spark, sf_dir):
    return _windows(rolling.rolling_stats_from_panes(tables.ticks(spark, sf_dir), "6 hours", "30 minutes"))


def rolling_stats_uneven(spark, sf_dir):
    """A duration that is no multiple of the slide, through panes."""
    return _windows(rolling.rolling_stats_from_panes(tables.ticks(spark, sf_dir), "5 hours", "2 hours"))


def tumbling_stats(spark, sf_dir):
    result = rolling.rolling_stats(tables.ticks(spark, sf_dir), "1 day", "1 day", harmonic=True)
    return plain(result, _rounded((*WINDOW_VALUES, "harmonic_mean"), 6))


def rolling_history(spark, sf_dir):
    return _windows(lookups.rolling_history(rolling.rolling_stats(tables.ticks(spark, sf_dir)), "click"))


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks with the one metric winners and losers need, so that no poll totals have to be computed."""
    return tables.ticks(spark, sf_dir).withColumn("percent_change", percent_change())


def top_winners(spark, sf_dir):
    return plain(boards.top_winners(_changes(spark, sf_dir)))


def top_losers(spark, sf_dir):
    return plain(boards.top_losers(_changes(spark, sf_dir)))


def ranked_winners(spark, sf_dir):
    return plain(boards.ranked_winners(_changes(spark, sf_dir)))


def market_share(spark, sf_dir):
    return plain(boards.market_share(live.with_metrics(_ticks(spark, sf_dir))))


def latest_winners(spark, sf_dir):
    return plain(boards.top_winners(_changes(spark, sf_dir), pick="latest"))


def latest_market_share(spark, sf_dir):
    return plain(boards.market_share(live.with_metrics(_ticks(spark, sf_dir)), pick="latest"))


# Messages and payloads ------------------------------------------------------------------------------------------------


def tick_messages(spark, sf_dir):
    """Keyed JSON messages written to files and parsed again."""
    path = f"{work_dir(spark, 'messages')}/messages"
    publish_to_files(_ticks(spark, sf_dir), path)
    return plain(parse_ticks(read_message_files(spark, path), keep=("key",)))


def _damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ticks as messages, each damaged in one of four ways or left alone."""
    messages = to_messages(_ticks(spark, sf_dir))
    value = F.col("value")
    kind = F.pmod(F.get_json_object(value, "$.price_old").cast("double").cast("int"), F.lit(5))
    damaged = (
        F.when(kind == 1, F.regexp_replace(value, '"name_coin":"[^"]*",', ""))
        .when(kind == 2, F.regexp_replace(value, r'"time_stamp":(\d+)', r'"time_stamp":$1000'))
        .when(kind == 3, F.expr("left(value, length(value) - 20)"))
        .when(kind == 4, F.regexp_replace(value, r'"time_stamp":\d+', '"time_stamp":null'))
        .otherwise(value)
    )
    return messages.select("key", damaged.alias("value"))


def tick_rejects(spark, sf_dir):
    """Damaged messages counted by the reason they are set aside for."""
    ticks = parse_ticks(_damaged_messages(spark, sf_dir).select(F.col("value").cast("binary").alias("value")))
    reason = F.coalesce(reject_reason(), F.lit("none"))
    return ticks.groupBy(reason.alias("reject_reason")).agg(F.count(F.lit(1)).alias("n"))


def payload_coins(spark, sf_dir):
    """Payload documents written as JSON lines, read back and flattened to ticks."""
    path = f"{work_dir(spark, 'payloads')}/payloads"
    tables.payloads(spark, sf_dir).write.json(path)
    return plain(payload_ticks(read_payloads(spark, path)))


def payload_rejects(spark, sf_dir):
    """Payload documents of which one in four cannot be read and one in four misnames a field: what is set aside."""
    path, body = f"{work_dir(spark, 'damaged')}/payloads", F.col("body")
    kind = F.pmod(F.col("fetched_at"), F.lit(4))
    damaged = F.when(kind == 1, F.left(body, F.lit(5))).when(kind == 2, F.replace(body, F.lit('"price"'), F.lit('"prize"'))).otherwise(body)
    tables.payloads(spark, sf_dir).withColumn("body", damaged).write.json(path)
    what = F.when(F.col("id").isNull(), "document").otherwise("coin").alias("what")
    return rejected_coins(read_payloads(spark, path)).groupBy(what).agg(F.count(F.lit(1)).alias("n"))


# Keyed tables ---------------------------------------------------------------------------------------------------------


def _hourly_prices(spark: SparkSession, sf_dir: str) -> tuple[KeyedTable, list[DataFrame]]:
    """A price table keyed by symbol and hour, and the ticks in three batches that write each other's keys again."""
    hour = F.date_trunc("hour", F.col("time_stamp").cast("timestamp"))
    ticks = _ticks(spark, sf_dir).withColumn("time_stamp", hour)
    old = F.col("price_old")
    batches = [live.live_prices(ticks.where(part)) for part in (old < 33, (old >= 33) & (old < 66), old >= 66)]
    return KeyedTable.like(batches[0], schemas.REALTIME_PRICES, work_dir(spark, "hourly")), batches


def keyed_upsert(spark, sf_dir):
    table, batches = _hourly_prices(spark, sf_dir)
    for number, batch in enumerate(batches):
        table.write_batch(batch, number)
    return plain(table.latest(spark))


def keyed_upsert_compacted(spark, sf_dir):
    """The same table with its first two batches compacted."""
    table, batches = _hourly_prices(spark, sf_dir)
    for number, batch in enumerate(batches):
        table.write_batch(batch, number)
    table.compact(spark)
    return plain(table.latest(spark))


def stored_price_history(spark, sf_dir):
    """One symbol's hours up to a time, newest first, out of the partly compacted table."""
    table, batches = _hourly_prices(spark, sf_dir)
    for number, batch in enumerate(batches):
        table.write_batch(batch, number)
    table.compact(spark)
    wanted = (F.col("symbol_coin") == "view") & (F.col("time_stamp") < F.lit("2024-01-16").cast("timestamp"))
    return plain(lookups.price_history(table.latest(spark, wanted), "view"))


def price_history_by_day(spark, sf_dir):
    """The same range as ``price_history``, out of prices stored by day."""
    path, prices = f"{work_dir(spark, 'days')}/prices", live.live_prices(_ticks(spark, sf_dir))
    partitioned.write_by_day(prices, path)
    stored = partitioned.read_by_day(spark, path, prices.schema)
    return plain(partitioned.history(stored, "purchase", "2024-01-08", "2024-01-22"))


# Streams: the ticks as message files, one availableNow run into a fresh table, and the table read back ----------------


def _message_stream(
    spark: SparkSession, sf_dir: str, label: str, batches: int = 1
) -> tuple[SparkSession, str, DataFrame]:
    """The messages as a stream; for several batches as that many times as many files as the cluster has cores, so that
    each batch is read by all of them."""
    root = work_dir(spark, label)
    ticks, files = _ticks(spark, sf_dir), spark.sparkContext.defaultParallelism
    publish_to_files(ticks.repartition(batches * files) if batches > 1 else ticks, f"{root}/messages")
    session = streaming_session(spark)
    return session, root, read_message_files_stream(session, f"{root}/messages", files_per_batch=files if batches > 1 else None)


def _run(spark: SparkSession, sf_dir: str, name: str, batches: int = 1) -> KeyedTable:
    _, root, messages = _message_stream(spark, sf_dir, name, batches)
    table, query = streams.start_query(name, landing.accepted_ticks(messages), root, availableNow=True)
    streams.await_all([query])
    return table


def stream_live_prices(spark, sf_dir):
    return plain(_run(spark, sf_dir, "live_prices").latest(spark))


def stream_rolling_stats(spark, sf_dir):
    return _windows(_run(spark, sf_dir, "rolling_stats").latest(spark))


def stream_top_winners(spark, sf_dir):
    table = _run(spark, sf_dir, "top_winners")
    return plain(lookups.winners_view(table.last_snapshot(spark)).drop("snapshot_id"))


def stream_top_winners_batches(spark, sf_dir):
    """The ticks in three batches: the board after the last is that of all ticks."""
    table = _run(spark, sf_dir, "top_winners", batches=3)
    return plain(lookups.winners_view(table.last_snapshot(spark)).drop("snapshot_id"))


def stream_top_losers(spark, sf_dir):
    table = _run(spark, sf_dir, "top_losers")
    return plain(lookups.losers_view(table.last_snapshot(spark)).drop("snapshot_id"))


def stream_market_share(spark, sf_dir):
    table = _run(spark, sf_dir, "market_share")
    return plain(lookups.share_view(table.last_snapshot(spark)).drop("snapshot_id"))


def stream_market_share_batches(spark, sf_dir):
    table = _run(spark, sf_dir, "market_share", batches=3)
    return plain(lookups.share_view(table.last_snapshot(spark)).drop("snapshot_id"))


def _kept_board(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A board kept up to date over four batches."""
    _, root, messages = _message_stream(spark, sf_dir, name, batches=4)
    ticks = landing.accepted_ticks(messages)
    kept, query = incremental_boards.start_board(name, ticks, root, availableNow=True)
    streams.await_all([query])
    return plain(kept.boards.last_snapshot(spark).drop("snapshot_id"))


def stream_top_winners_kept(spark, sf_dir):
    return _kept_board(spark, sf_dir, "top_winners")


def stream_top_losers_kept(spark, sf_dir):
    return _kept_board(spark, sf_dir, "top_losers")


def stream_market_share_kept(spark, sf_dir):
    return _kept_board(spark, sf_dir, "market_share")


def stream_ranked_winners(spark, sf_dir):
    """Winners ranked with ties inside each of three micro-batches."""
    _, root, messages = _message_stream(spark, sf_dir, "ranked", batches=3)
    coins = boards.leaders(live.with_metrics(landing.accepted_ticks(messages)))
    table = KeyedTable.like(coins, schemas.BIGGEST_WINNERS, f"{root}/ranked")

    def rank(batch: DataFrame, number: int) -> None:
        table.write_batch(boards.ranked_winners(batch), number)

    writer = coins.writeStream.outputMode("complete").foreachBatch(rank).option("checkpointLocation", table.checkpoint)
    streams.await_all([writer.trigger(availableNow=True).start()])
    return plain(table.last_snapshot(spark).drop("snapshot_id"))


def stream_snapshot_totals(spark, sf_dir):
    """Hourly totals put on the ticks of a feed that has none; a last tick, far ahead, ends all hours."""
    root = work_dir(spark, "totals")
    ticks = _ticks(spark, sf_dir)
    bare = ticks.unionByName(_flush(ticks)).withColumns({name: F.lit(None).cast("double") for name in ("total_24_volume", "total_market_cap")})
    publish_to_files(bare, f"{root}/messages")
    messages = read_message_files_stream(streaming_session(spark), f"{root}/messages")
    totals = streams.totals_stream(landing.accepted_ticks(messages))
    contract = schemas.ResultTable("tick_totals", ("id", "time_stamp", "total_24_volume", "total_market_cap"), ("id",), "crypto")
    table = KeyedTable.like(totals, contract, f"{root}/totals")
    streams.await_all([streams.upsert_stream(totals, table, "append", availableNow=True)])
    return plain(table.latest(spark).drop("time_stamp"))


def stream_landing(spark, sf_dir):
    """Damaged messages landed by the shared step: its accepted ticks and its quarantine, counted by reason."""
    root = work_dir(spark, "landing")
    _damaged_messages(spark, sf_dir).write.parquet(f"{root}/messages")
    messages = read_message_files_stream(streaming_session(spark), f"{root}/messages")
    landed = f"{root}/ticks"
    streams.await_all([landing.land_ticks(messages, landed, f"{root}/checkpoint", availableNow=True)])
    accepted = landing.read_landed(spark, landed).select(F.lit("none").alias("reject_reason"))
    rejected = landing.read_quarantine(spark, landed).select("reject_reason")
    return accepted.unionByName(rejected).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def _flush(ticks: DataFrame, days: int = 400) -> DataFrame:
    """One tick, later than all others by far: behind it every window is closed."""
    fields = [field for field in ticks.schema.fields if field.name not in ("name_coin", "symbol_coin", "time_stamp")]
    newest = ticks.agg(F.timestamp_add("DAY", F.lit(days), F.max("time_stamp")).alias("time_stamp"))
    empty = {field.name: F.lit(None).cast(field.dataType) for field in fields}
    return newest.select("time_stamp", F.lit("flush").alias("name_coin"), F.lit("flush").alias("symbol_coin"), *[c.alias(n) for n, c in empty.items()])


def stream_rolling_stats_panes(spark, sf_dir):
    """The ticks in three batches through panes; a last tick, far ahead, closes all windows."""
    root = work_dir(spark, "panes")
    ticks = _ticks(spark, sf_dir)
    publish_to_files(ticks.unionByName(_flush(ticks)).repartitionByRange(3, "time_stamp"), f"{root}/messages")
    messages = read_message_files_stream(streaming_session(spark), f"{root}/messages")
    table, query = streams.start_query("rolling_stats_panes", landing.accepted_ticks(messages), root, availableNow=True)
    streams.await_all([query])
    return _windows(table.latest(spark))


def _landed_with_late_ticks(spark: SparkSession, sf_dir: str) -> tuple[SparkSession, str, str]:
    """A landing folder of four batches: ten days each but for the last, to which a tenth of the ticks of each batch come
    a batch too late."""
    root = work_dir(spark, "late")
    ticks = _ticks(spark, sf_dir)
    day = F.col("time_stamp").cast("date")
    due = F.when(day < F.lit("2024-01-11"), 0).when(day < F.lit("2024-01-21"), 1).otherwise(2)
    ticks = ticks.withColumn("batch", due + F.when(F.col("price_old") % 10 == 3, 1).otherwise(0))
    session, landed = streaming_session(spark), f"{root}/ticks"
    for batch in range(4):
        publish_to_files(ticks.where(F.col("batch") == batch).drop("batch"), f"{root}/messages/{batch}")
        messages = read_message_files_stream(session, f"{root}/messages/*")
        streams.await_all([lateness.land_ticks_marked(messages, landed, f"{root}/ticks_checkpoint", availableNow=True)])
    return session, root, landed


def stream_on_time_stats(spark, sf_dir):
    """Window statistics of a stream with late ticks: each tick is in the windows that were open when it came."""
    session, root, landed = _landed_with_late_ticks(spark, sf_dir)
    stats = lateness.rolling_on_time_stream(lateness.read_marked_stream(session, landed))
    table = streams.open_table(stats, schemas.ROLLING_MEANS, root, "files")
    streams.await_all([streams.upsert_stream(stats, table, "update", availableNow=True)])
    return _windows(table.latest(spark))


def stream_late_ticks(spark, sf_dir):
    """The late ticks of the same stream, out of its landing folder."""
    _, _, landed = _landed_with_late_ticks(spark, sf_dir)
    late = lateness.late_ticks(lateness.read_marked(spark, landed))
    return plain(late.select("id", "time_stamp", "high_water", "missed_windows", "reject_reason"))


def stream_all(spark, sf_dir):
    """Landing first, then all five queries at once on the landed ticks; the size and newest time of each table."""
    session, root, messages = _message_stream(spark, sf_dir, "all")
    landed = f"{root}/ticks"
    streams.await_all([landing.land_ticks(messages, landed, f"{root}/ticks_checkpoint", availableNow=True)])
    started = streams.start_all(landing.read_landed_stream(session, landed), root, availableNow=True)
    streams.await_all([query for _, query in started.values()])
    sizes = [
        (table.last_snapshot(spark) if name in BOARDS else table.latest(spark)).agg(
            F.lit(name).alias("result"),
            F.count(F.lit(1)).alias("n"),
            F.max("end_time" if name == "rolling_stats" else "time_stamp").alias("newest"),
        )
        for name, (table, _) in started.items()
    ]
    return plain(reduce(DataFrame.unionByName, sizes))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        bars_by_month,
        bars_by_year,
        bars_by_year_from_months,
        daily_bars_by_month,
        daily_bars_by_year,
        month_bar_lookup,
        year_bar_lookup,
        asset_summary,
        formatted_summary,
        formatted_bars,
        top_bars,
        top_bars_by_volume,
        top_bars_by_asset,
        top_bars_by_asset_volume,
        bars_by_month_of_runs,
        bars_by_year_of_runs,
        csv_bars,
        csv_rejects,
        job_bar_problems,
        job_month_bars,
        job_year_bars,
        job_asset_summary,
        job_top_bars,
        tick_metrics,
        tick_metrics_decimal,
        live_prices,
        snapshot_totals,
        latest_ticks,
        price_history,
        rolling_stats,
        rolling_stats_half_hourly,
        rolling_stats_from_panes,
        rolling_stats_uneven,
        tumbling_stats,
        rolling_history,
        top_winners,
        top_losers,
        ranked_winners,
        market_share,
        latest_winners,
        latest_market_share,
        tick_messages,
        tick_rejects,
        payload_coins,
        payload_rejects,
        keyed_upsert,
        keyed_upsert_compacted,
        stored_price_history,
        price_history_by_day,
        stream_live_prices,
        stream_rolling_stats,
        stream_top_winners,
        stream_top_winners_batches,
        stream_top_losers,
        stream_market_share,
        stream_market_share_batches,
        stream_top_winners_kept,
        stream_top_losers_kept,
        stream_market_share_kept,
        stream_ranked_winners,
        stream_snapshot_totals,
        stream_landing,
        stream_rolling_stats_panes,
        stream_on_time_stats,
        stream_late_ticks,
        stream_all,
    )
}


def registered() -> dict[str, Query]:
    """Every query, run in UTC."""

    def in_utc(query: Query) -> Query:
        return lambda spark, sf_dir: query(use_utc(spark), sf_dir)

    return {name: in_utc(query) for name, query in QUERIES.items()}
