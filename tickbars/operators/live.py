"""Per-tick metrics and poll totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tickbars.functions import metrics
from tickbars.session import work_dir


def with_metrics(ticks: DataFrame, as_type: str = "double") -> DataFrame:
    """Add the four derived metrics to every tick."""
    return ticks.withColumns(
        {
            "percent_volume": metrics.percent_volume(as_type),
            "percent_market_cap": metrics.percent_market_cap(as_type),
            "percent_change": metrics.percent_change(as_type),
            "cir_supply": metrics.circulating_supply(as_type),
        }
    )


def live_prices(ticks: DataFrame, as_type: str = "double") -> DataFrame:
    """Price-tracking rows: one per tick, metrics added, working fields left out."""
    return with_metrics(ticks, as_type).drop(
        "id", "price_old", "percent_change_24hr", "total_24_volume", "total_market_cap"
    )


def with_daily_totals(ticks: DataFrame, time: str = "time_stamp") -> DataFrame:
    """Put each day's total volume and market capitalisation on all its ticks, for feeds that carry no totals.

    Totals are combined per task before the shuffle. They hold one row per calendar day, some 3.7 million at the very
    most over all dates Spark can represent, so sending them to every task is safe and the ticks stay where they are.
    """
    day = F.col(time).cast("date")
    totals = ticks.groupBy(day.alias("day")).agg(
        F.try_sum("volume").alias("total_24_volume"), F.try_sum("market_cap").alias("total_market_cap")
    )
    return ticks.withColumn("day", day).join(F.broadcast(totals), "day", "left").drop("day")


def with_window_totals(ticks: DataFrame, duration: str) -> DataFrame:
    """Ticks with the totals of the window they are in, for a stream without totals (and for a table just as well).

    On a stream the totals are a windowed aggregation, which gives a window's totals when the watermark has passed its
    end, and the ticks wait for them in a stream-stream join on the window. The window bounds the time on both sides, so
    ticks are let go when their window is over. Needs a watermark on ``time_stamp`` and append mode.
    """
    totals = ticks.groupBy(F.window("time_stamp", duration)).agg(
        F.try_sum("volume").alias("total_24_volume"), F.try_sum("market_cap").alias("total_market_cap")
    )
    # A stream may have one event time a side, which here is the window: the tick's own time goes on as a plain value.
    others = [F.col(name) for name in ticks.columns if name not in ("total_24_volume", "total_market_cap", "time_stamp")]
    time = F.col("time_stamp") + F.make_dt_interval()
    placed = ticks.select(*others, time.alias("time_stamp"), F.window("time_stamp", duration).alias("window"))
    return placed.join(totals, "window").drop("window")


def with_snapshot_totals(ticks: DataFrame, snapshot: str) -> DataFrame:
    """The same for an arbitrary snapshot column; the join strategy is left to Spark, as nothing bounds its values."""
    totals = ticks.groupBy(snapshot).agg(
        F.try_sum("volume").alias("total_24_volume"), F.try_sum("market_cap").alias("total_market_cap")
    )
    return ticks.join(totals, snapshot, "left")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The newest row of each key; the remaining columns break ties, so the choice never depends on arrival.

    An aggregation rather than a window: each task reduces a key to one row before the shuffle, and the plan is legal on
    a stream.
    """
    others = [name for name in df.columns if name not in keys]
    position = [F.col(o) if isinstance(o, str) else o for o in order]
    row = F.struct(*[p.alias(f"order_{i}") for i, p in enumerate(position)], *others)
    newest = df.groupBy(*keys).agg(F.max(row).alias("newest"))
    return newest.select(*[F.col(name) if name in keys else F.col(f"newest.{name}") for name in df.columns])


#: The newest times of so many keys are sent to every task; their rows are then found without a shuffle.
MOST_KEYS = 1 << 20


def newest_per_key(df: DataFrame, keys: list[str], order: str, most_keys: int = MOST_KEYS) -> DataFrame:
    """What ``latest_per_key`` gives for one ``order`` column of a fixed width, without sorting the rows; batch only.

    First the newest value per key, which fits a hash aggregation; then the rows that have it, by a semi-join; and for
    the keys of which several rows have it, the tie-break of ``latest_per_key``, which is the only step that sorts. The
    newest values and the tied keys are stored and counted: up to ``most_keys`` of them are broadcast and the rows stay
    where they are read. Beyond, both sides are dealt by key and value, so a key with a third of all rows is spread by
    its values. Where the first step has found no key twice, the rows are the result as they are. NULL is a key like any
    other, and older than any value.
    """

    def stored(found: DataFrame, label: str) -> tuple[DataFrame, int, int]:
        """What was found, without the rows per key in its last column, the number of keys and that of their rows."""
        path, seen = f"{work_dir(df.sparkSession, label)}/rows", Observation()
        found = found.toDF(*[f"{label}_{i}" for i in range(len(found.columns))])
        per_key = found.columns[-1]
        found = found.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(per_key).alias("rows")).drop(per_key)
        found.write.parquet(path)
        found, n = df.sparkSession.read.schema(found.schema).parquet(path), seen.get["n"]
        return (F.broadcast(found) if n <= most_keys else found), n, seen.get["rows"] or 0

    def same(names: list[str], there: DataFrame, label: str) -> list[Column]:
        return [df[name].eqNullSafe(there[f"{label}_{i}"]) for i, name in enumerate(names)]

    count = F.count(F.lit(1)).alias("n")
    newest, n, all_rows = stored(df.groupBy(*keys).agg(F.max(order), count), "newest")
    if n == all_rows:
        return df
    rows = df.join(newest, same([*keys, order], newest, "newest"), "left_semi")
    tied, ties, _ = stored(rows.groupBy(*keys).agg(count).where("n > 1"), "tied")
    if not ties:
        return rows
    alone = rows.join(tied, same(keys, tied, "tied"), "left_anti")
    return alone.unionByName(latest_per_key(rows.join(tied, same(keys, tied, "tied"), "left_semi"), keys, [order]))
