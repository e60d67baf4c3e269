"""The five streaming queries, each upserting into its own keyed table."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickbars import schemas
from tickbars.operators import boards
from tickbars.operators.live import live_prices, with_metrics, with_window_totals
from tickbars.operators.rolling import rolling_stats, rolling_stats_from_panes
from tickbars.schemas import SLIDE_DURATION, WATERMARK, WINDOW_DURATION, ResultTable
from tickbars.sinks.external import CassandraTable
from tickbars.sinks.keyed import KeyedTable
from tickbars.streaming.incremental_boards import RULES, start_board
from tickbars.streaming.lateness import rolling_on_time_stream

Table = KeyedTable | CassandraTable


def rolling_stream(
    ticks: DataFrame,
    watermark: str = WATERMARK,
    duration: str = WINDOW_DURATION,
    slide: str = SLIDE_DURATION,
) -> DataFrame:
    """Window statistics whose windows close, and whose late ticks are dropped, ``watermark`` after the newest tick."""
    return rolling_stats(ticks.withWatermark("time_stamp", watermark), duration, slide)


def rolling_panes_stream(
    ticks: DataFrame,
    watermark: str = WATERMARK,
    duration: str = WINDOW_DURATION,
    slide: str = SLIDE_DURATION,
) -> DataFrame:
    """The same statistics through panes, in append mode: each window once, when the watermark has passed its end."""
    return rolling_stats_from_panes(ticks.withWatermark("time_stamp", watermark), duration, slide)


def totals_stream(ticks: DataFrame, snapshot: str = "1 hour", watermark: str = WATERMARK) -> DataFrame:
    """Ticks of a feed without totals, with those of their snapshot, in append mode once the snapshot is over."""
    return with_window_totals(ticks.withWatermark("time_stamp", watermark), snapshot)


# Each query: the result it computes from a tick stream, its table, and its output mode. Updated windows are emitted
# again as a whole, hence the upsert; boards are sorted, which a stream allows in complete mode only.
QUERIES: dict[str, tuple[Callable[[DataFrame], DataFrame], ResultTable, str]] = {
    "live_prices": (live_prices, schemas.REALTIME_PRICES, "update"),
    "rolling_stats": (rolling_stream, schemas.ROLLING_MEANS, "update"),
    "top_winners": (lambda ticks: boards.top_winners(with_metrics(ticks)), schemas.BIGGEST_WINNERS, "complete"),
    "top_losers": (lambda ticks: boards.top_losers(with_metrics(ticks)), schemas.BIGGEST_LOSERS, "complete"),
    "market_share": (lambda ticks: boards.market_share(with_metrics(ticks)), schemas.MARKET_SHARE, "complete"),
}

#: Takes the place of ``rolling_stats`` where a window's first result may wait until it closes.
CLOSED_WINDOWS = {"rolling_stats_panes": (rolling_panes_stream, schemas.ROLLING_MEANS, "append")}


def upsert_stream(df: DataFrame, table: Table, output_mode: str, **trigger) -> StreamingQuery:
    """Write every micro-batch to ``table`` under its batch number: a batch repeated after a failure replaces itself.

    Columns that the table does not keep are left out here, where the plan can still drop them from the state before it.
    """
    writer = df.select(*table.contract.columns).writeStream.queryName(table.contract.name).outputMode(output_mode)
    writer = writer.option("checkpointLocation", table.checkpoint).foreachBatch(table.write_batch)
    return writer.trigger(**(trigger or {"processingTime": "0 seconds"})).start()


def start_query(
    name: str, ticks: DataFrame, root: str, *, store: str = "files", on_time: bool = False, **trigger
) -> tuple[Table, StreamingQuery]:
    """Start one of ``QUERIES`` or ``CLOSED_WINDOWS`` on a tick stream, with its progress and (``store="files"``) its table under ``root``."""
    compute, contract, mode = (QUERIES | CLOSED_WINDOWS)[name]
    if on_time and name == "rolling_stats":
        compute = rolling_on_time_stream
    result = compute(ticks)
    table = open_table(result, contract, root, store)
    return table, upsert_stream(result, table, mode, **trigger)


def open_table(result: DataFrame, contract: ResultTable, root: str, store: str) -> Table:
    folder = f"{root.rstrip('/')}/{contract.name}"
    if store == "files":
        return KeyedTable.like(result, contract, folder)
    if store == "cassandra":
        return CassandraTable(contract, f"{folder}/checkpoint")
    raise ValueError(f"store must be 'files' or 'cassandra', not {store!r}")


def start_all(
    ticks: DataFrame, root: str, *, kept_boards: bool = False, store: str = "files", on_time: bool = False, **trigger
) -> dict[str, tuple[Table, StreamingQuery]]:
    """Start all five on one landed tick stream; they share nothing else and restart on their own.

    ``kept_boards`` keeps the boards up to date from stored partials instead of complete mode (file tables only);
    ``on_time`` says that the ticks carry the marks of ``lateness``, by which windows closed for a tick are left out.
    """
    if kept_boards and store != "files":
        raise ValueError("boards are kept up to date in file tables only")
    started = {}
    for name in QUERIES:
        if kept_boards and name in RULES:
            kept, query = start_board(name, ticks, root, **trigger)
            started[name] = kept.boards, query
        else:
            started[name] = start_query(name, ticks, root, store=store, on_time=on_time, **trigger)
    return started


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait for queries that end by themselves (``availableNow``); the first failure stops the others."""
    running = list(queries)
    try:
        for query in running:
            query.awaitTermination()
    finally:
        _stop(running)


def await_any(spark: SparkSession, queries: Iterable[StreamingQuery]) -> None:
    """Wait until any endless query of the session stops, then stop the others; a failure is raised."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        _stop(queries)


def _stop(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()
