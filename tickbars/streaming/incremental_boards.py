"""Boards kept up to date from the coins that a batch changes.

In complete mode a board's query keeps one state row per coin, and gives all of them out and sorts them again in every
batch. Here the stream has no state: a batch is reduced to one partial per coin, which is merged with the stored partial
of that coin, and only the merged coins are written. Partials are maxima, or the newest tick, so merging is the same
aggregation once more.

The new board is taken from the board before and the changed coins. That is enough as long as no coin of the board before
has lost its place by its own value: an unchanged coin outside was behind all of them and still is. Otherwise, as when a
loser recovers, the board is looked up among all stored coins.

A batch repeated after a failure starts from the state before it and replaces what it wrote. Every ``compact_every`` batches
the stored partials are compacted, so that a batch reads one row per coin and what the last batches changed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickbars import schemas
from tickbars.operators import boards
from tickbars.operators.live import with_metrics
from tickbars.schemas import BOARD_SIZE, ResultTable
from tickbars.sinks.keyed import KeyedTable

#: Up to so many changed coins are looked up by name, which the stored files can be skipped by; more are joined.
FEW = 1000
NAME = "name_coin"


@dataclass(frozen=True)
class BoardRule:
    """What a board shows of a coin, and the order it has."""

    columns: tuple[str, ...]
    by: str
    descending: bool
    contract: ResultTable

    def partials(self, metrics: DataFrame, pick: str) -> DataFrame:
        return boards.per_coin(metrics, list(self.columns), pick)

    def top(self, coins: DataFrame, n: int) -> DataFrame:
        order = F.col(self.by).desc_nulls_last() if self.descending else F.col(self.by).asc_nulls_last()
        return boards.board(coins, order, n)

    def place(self, row) -> tuple:
        """The order again, for comparing two states of one coin; NaN stands above all other values."""
        value = row[self.by]
        if value is None:
            return (1, 0, 0.0)
        nan = math.isnan(value)
        return (0, int(nan) * (-1 if self.descending else 1), 0.0 if nan else -value if self.descending else value)


_CHANGE, _SHARE = ("price", "percent_change"), ("percent_volume", "percent_market_cap")
RULES = {
    "top_winners": BoardRule(_CHANGE, "percent_change", True, schemas.BIGGEST_WINNERS),
    "top_losers": BoardRule(_CHANGE, "percent_change", False, schemas.BIGGEST_LOSERS),
    "market_share": BoardRule(_SHARE, "percent_market_cap", True, schemas.MARKET_SHARE),
}


@dataclass(frozen=True)
class IncrementalBoard:
    """The stored partials of all coins and the board after each batch."""

    rule: BoardRule
    coins: KeyedTable
    boards: KeyedTable
    n: int = BOARD_SIZE
    pick: str = "max"
    compact_every: int = 100

    @classmethod
    def like(cls, metrics: DataFrame, name: str, root: str, n: int = BOARD_SIZE, pick: str = "max", **options) -> IncrementalBoard:
        """Board ``name`` of ``RULES`` under ``root`` for ticks shaped like ``metrics``."""
        rule, folder = RULES[name], f"{root.rstrip('/')}/{RULES[name].contract.name}"
        partials = rule.partials(metrics, pick)
        stored = ResultTable(f"{rule.contract.name}_coins", tuple(partials.columns), (NAME,), rule.contract.keyspace)
        coins = KeyedTable.like(partials, stored, f"{folder}_coins")
        return cls(rule, coins, KeyedTable.like(partials, rule.contract, folder), n, pick, **options)

    def write_batch(self, metrics: DataFrame, batch_id: int) -> None:
        spark = metrics.sparkSession
        changed = self.rule.partials(metrics, self.pick).persist()
        try:
            stored = self._stored(changed, batch_id - 1)
            merged = self.rule.partials(changed.unionByName(stored), self.pick)
            self.coins.write_batch(merged, batch_id)
        finally:
            changed.unpersist()
        merged = self.coins.log(spark, batch_id - 1, batch_id).select(*self.coins.contract.columns)
        before = self._board_before(spark, batch_id)
        names = [row[NAME] for row in before]
        now = {row[NAME]: row for row in merged.where(F.col(NAME).isin(names)).head(self.n)} if names else {}
        if any(self.rule.place(now[row[NAME]]) > self.rule.place(row) for row in before if row[NAME] in now):
            candidates = self.coins.latest(spark, upto=batch_id)
        else:
            same = [row for row in before if row[NAME] not in now]
            candidates = merged.unionByName(spark.createDataFrame(same, self.boards.schema)) if same else merged
        self.boards.write_batch(self.rule.top(candidates, self.n), batch_id)
        if batch_id and batch_id % self.compact_every == 0:
            self.coins.compact(spark)

    def _stored(self, changed: DataFrame, upto: int) -> DataFrame:
        """The partials that the changed coins had before."""
        spark = changed.sparkSession
        names = [row[NAME] for row in changed.select(NAME).head(FEW + 1)]
        if len(names) <= FEW and None not in names:
            return self.coins.latest(spark, F.col(NAME).isin(names), upto)
        stored = self.coins.latest(spark, upto=upto)
        return stored.join(changed.select(F.col(NAME).alias("changed")), F.col(NAME).eqNullSafe(F.col("changed")), "left_semi")

    def _board_before(self, spark, batch_id: int) -> list:
        """At most ``n`` rows: the board as the newest earlier batch left it."""
        earlier = self.boards.log(spark, upto=batch_id - 1)
        newest = earlier.agg(F.max("batch_id")).first()[0]
        if newest is None:
            return []
        return self.boards.log(spark, newest - 1, newest).drop("batch_id").head(self.n)


def start_board(
    name: str, ticks: DataFrame, root: str, *, n: int = BOARD_SIZE, pick: str = "max", **trigger
) -> tuple[IncrementalBoard, StreamingQuery]:
    """Keep one of ``RULES`` up to date on a tick stream."""
    metrics = with_metrics(ticks)
    kept = IncrementalBoard.like(metrics, name, root, n, pick)
    writer = metrics.writeStream.queryName(f"{kept.boards.contract.name}_incremental").outputMode("append")
    writer = writer.option("checkpointLocation", kept.boards.checkpoint).foreachBatch(kept.write_batch)
    return kept, writer.trigger(**(trigger or {"processingTime": "0 seconds"})).start()
