"""The batch and streaming jobs as commands, with every path a parameter.

    spark-submit run_tickbars.py land     --input 'bars/*.csv' --output /landed/bars
    spark-submit run_tickbars.py bars     --input 'bars/*.csv' --output /tables --run 20240131
    spark-submit run_tickbars.py summary  --input quotes.csv   --output /tables --run 20240131
    spark-submit run_tickbars.py top-bars --input /landed/bars --landed --output /tables --run 20240131
    spark-submit run_tickbars.py stream   --servers host:9092  --output /tables
    spark-submit run_tickbars.py compact  --output /tables     --table crypto_rolling_means
"""

from __future__ import annotations

import argparse

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tickbars import schemas
from tickbars.operators import quality, ranking, rollups
from tickbars.schemas import POLL_INTERVAL, QUOTE, TOPIC, ResultTable
from tickbars.session import streaming_session, use_utc
from tickbars.sinks.keyed import KeyedTable
from tickbars.sources import bars as bar_source
from tickbars.sources.ticks import read_topic_stream
from tickbars.streaming import landing, lateness, queries
from tickbars.streaming.queries import Table, open_table


def _bars(spark: SparkSession, paths, landed: bool) -> DataFrame:
    """Bars from CSV files, or from what ``land`` made of them: parquet that is parsed no more than once."""
    read = bar_source.read_landed_bars if landed else bar_source.read_bars
    return read(use_utc(spark), paths)


def _store(result: DataFrame, contract: ResultTable, root: str, run_id: int, store: str) -> Table:
    table = open_table(result, contract, root, store)
    table.write_batch(result, run_id)
    return table


def bar_rollups(
    spark: SparkSession,
    paths,
    root: str,
    run_id: int,
    store: str = "files",
    landed: bool = False,
    unique_sequence: bool = True,
) -> tuple[Table, Table]:
    """Month and year bars of all assets from one read of the files: years are put together from the months.

    For CSV files the lines that were no bars are counted by their problem in the same read, into ``bar_problems``.

    A bar file has one numbered row per day, so (Name, Date, SNo) identifies a bar. For files that repeat it,
    ``unique_sequence=False`` settles first and last by price.
    """
    seen = None
    if landed:
        bars = _bars(spark, paths, landed)
    else:
        bars, seen = bar_source.counted_bars(bar_source.read_bar_lines(use_utc(spark), paths))
    months = rollups.period_base(bars, "month", unique_sequence=unique_sequence).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        month_table = _store(rollups.labelled(months, "month"), schemas.MONTH_BARS, root, run_id, store)
        if seen:
            counts = [(problem, n) for problem, n in seen.get.items() if problem != "lines"]
            bar_problems(spark, root).write_batch(spark.createDataFrame(counts, "problem string, n long"), run_id)
        years = rollups.labelled(rollups.year_base_from_months(months), "year")
        return month_table, _store(years, schemas.YEAR_BARS, root, run_id, store)
    finally:
        months.unpersist()


def bar_problems(spark: SparkSession, root: str) -> KeyedTable:
    """Counts of the lines that were no bars, by problem; a snapshot per run."""
    contract = ResultTable("bar_problems", ("problem", "n"), ("problem",), schemas.MONTH_BARS.keyspace)
    like = spark.createDataFrame([], "problem string, n long")
    return KeyedTable.like(like, contract, f"{root.rstrip('/')}/{contract.name}")


def bar_rollups_of_new(
    spark: SparkSession, paths, root: str, run_id: int, landed: bool = False, unique_sequence: bool = True
) -> tuple[KeyedTable, KeyedTable]:
    """Month and year bars when bars arrive run by run: ``paths`` are the bars of this run alone.

    A run is reduced to one partial per asset and month, which is stored under its number; earlier bars are not read
    again. The tables are put together from the stored partials of all runs, whose number is that of assets and months,
    not of bars. Repeating a run replaces its partials, whichever run it is, and the newest state of the tables is always
    their last snapshot.
    """
    bars = _bars(spark, paths, landed)
    partials = rollups.period_partials(bars, "month", unique_sequence=unique_sequence)
    contract = ResultTable("crypto_month_partials", tuple(partials.columns), ("name", "period"), schemas.MONTH_BARS.keyspace)
    stored = KeyedTable.like(partials, contract, f"{root.rstrip('/')}/{contract.name}")
    stored.write_batch(partials, run_id)
    months = rollups.merged_partials(stored.log(spark)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        month_table = _restated(spark, rollups.labelled(months, "month"), schemas.MONTH_BARS, root, run_id)
        years = rollups.labelled(rollups.year_base_from_months(months), "year")
        return month_table, _restated(spark, years, schemas.YEAR_BARS, root, run_id)
    finally:
        months.unpersist()


def _restated(spark: SparkSession, result: DataFrame, contract: ResultTable, root: str, run_id: int) -> KeyedTable:
    """Store a whole table as its newest snapshot, also when an older run was repeated."""
    table = KeyedTable.like(result, contract, f"{root.rstrip('/')}/{contract.name}")
    newest = table.snapshots(spark).agg({"snapshot_id": "max"}).first()[0]
    table.write_batch(result, run_id if newest is None else max(run_id, newest))
    return table


def asset_summary(spark: SparkSession, paths, root: str, run_id: int, store: str = "files") -> Table:
    """The summaries; the quotes read and those left out as incomplete are counted on the way, into ``quote_counts``."""
    raw = bar_source.read_quotes_raw(use_utc(spark), paths)
    quotes, seen = quality.counted(raw, QUOTE.fieldNames(), "quotes")
    table = _store(rollups.asset_summary(quotes), schemas.ASSET_SUMMARY, root, run_id, store)
    quote_counts(spark, root).write_batch(spark.createDataFrame(list(seen.get.items()), "what string, n long"), run_id)
    return table


def quote_counts(spark: SparkSession, root: str) -> KeyedTable:
    """``rows_read`` and ``rows_rejected`` of the quotes; a snapshot per run."""
    contract = ResultTable("quote_counts", ("what", "n"), ("what",), schemas.ASSET_SUMMARY.keyspace)
    return KeyedTable.like(spark.createDataFrame([], "what string, n long"), contract, f"{root.rstrip('/')}/{contract.name}")


def top_bars(
    spark: SparkSession, paths, root: str, run_id: int, store: str = "files", landed: bool = False
) -> Table:
    """The highest bars. Their value is looked up first, so the input is read twice: land large CSV inputs."""
    result = ranking.top_bars(_bars(spark, paths, landed))
    return _store(result, schemas.TOP_MARKETCAP, root, run_id, store)


def tick_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    root: str,
    *,
    state_partitions: int | None = None,
    store: str = "files",
    source_options: dict[str, str] | None = None,
    interval: str = POLL_INTERVAL,
    keep_late: bool = False,
    kept_boards: bool = False,
) -> None:
    """Land the topic once, run the five queries on the landed ticks, and end when any of them does.

    With ``keep_late`` ticks land with high-water marks: the rolling query leaves out the windows a tick was too late
    for, and ``lateness.late_ticks`` reads such ticks back. ``kept_boards`` keeps boards up to date without stream state.
    """
    session = streaming_session(spark, state_partitions=state_partitions)
    landed = f"{root.rstrip('/')}/ticks"
    messages = read_topic_stream(session, servers, topic, source_options)
    checkpoint = f"{root.rstrip('/')}/ticks_checkpoint"
    land = lateness.land_ticks_marked if keep_late else landing.land_ticks
    read = lateness.read_marked_stream if keep_late else landing.read_landed_stream
    started = [land(messages, landed, checkpoint, processingTime=interval)]
    results = queries.start_all(read(session, landed), root, store=store, on_time=keep_late, kept_boards=kept_boards)
    started += [query for _, query in results.values()]
    queries.await_any(session, started)


def compact(spark: SparkSession, root: str, table: str) -> None:
    """Compact one result table and drop what that replaces; a stream may go on writing to it meanwhile."""
    contract = schemas.RESULT_TABLES[table]
    stored = KeyedTable.open(use_utc(spark), contract, f"{root.rstrip('/')}/{contract.name}")
    stored.compact(spark)
    stored.drop_compacted(spark)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tickbars")
    commands = parser.add_subparsers(dest="command", required=True)
    batch_jobs = {"bars": bar_rollups, "summary": asset_summary, "top-bars": top_bars}
    for name in ("land", *batch_jobs):
        command = commands.add_parser(name)
        command.add_argument("--input", nargs="+", required=True)
        if name == "land":
            continue
        if name != "summary":
            command.add_argument("--landed", action="store_true", help="the input is parquet made by 'land'")
        if name == "bars":
            command.add_argument(
                "--repeated-sequence", action="store_true", help="(Name, Date, SNo) may occur more than once"
            )
        command.add_argument("--run", type=int, required=True, help="number of this run; repeating it replaces it")
    stream = commands.add_parser("stream")
    stream.add_argument("--servers", required=True)
    stream.add_argument("--topic", default=TOPIC)
    stream.add_argument("--state-partitions", type=int)
    stream.add_argument("--interval", default=POLL_INTERVAL, help="how often the topic is landed")
    stream.add_argument("--keep-late", action="store_true", help="set late ticks aside instead of losing them")
    stream.add_argument("--kept-boards", action="store_true", help="keep boards up to date without stream state")
    stream.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="option of the topic reader")
    compaction = commands.add_parser("compact")
    compaction.add_argument("--table", required=True, choices=sorted(schemas.RESULT_TABLES))
    for name, command in commands.choices.items():
        command.add_argument("--output", required=True)
        if name not in ("land", "compact"):
            command.add_argument("--store", choices=("files", "cassandra"), default="files")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"tickbars {args.command}").getOrCreate()
    if args.command == "stream":
        tick_stream(
            spark,
            args.servers,
            args.topic,
            args.output,
            state_partitions=args.state_partitions,
            store=args.store,
            interval=args.interval,
            keep_late=args.keep_late,
            kept_boards=args.kept_boards,
            source_options=dict(option.split("=", 1) for option in args.option),
        )
    elif args.command == "land":
        bar_source.land_bars(use_utc(spark), args.input, args.output)
    elif args.command == "compact":
        compact(spark, args.output, args.table)
    else:
        options = {"landed": args.landed} if "landed" in args else {}
        if args.command == "bars":
            options["unique_sequence"] = not args.repeated_sequence
        batch_jobs[args.command](spark, args.input, args.output, args.run, args.store, **options)
