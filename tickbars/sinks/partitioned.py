"""Stored ticks and windows that a lookup can skip most of.

Rows lie in one folder per day, sorted by symbol, and parquet keeps a Bloom filter of the symbols for every row group.
A lookup of one symbol and a time range opens the days of the range, and of these only the row groups that may have the
symbol: a symbol between the smallest and the largest of a row group, which statistics cannot rule out, is ruled out by
the filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = "day"


def write_by_day(
    df: DataFrame, path: str, time: str = "time_stamp", symbol: str = "symbol_coin", *, symbols: int = 100_000, files_per_day: int = 1
) -> None:
    """Store rows by the UTC day of ``time``; ``symbols`` is how many there may be in a row group, which sizes the filter.

    Rows are dealt by day and, for more than one file a day, by a hash of the symbol and time, so that a symbol with a
    third of all rows does not end up in one task.
    """
    part = F.pmod(F.xxhash64(symbol, time), F.lit(files_per_day))
    rows = df.withColumn(DAY, F.col(time).cast("date")).repartition(DAY, part).sortWithinPartitions(DAY, symbol, time)
    writer = rows.write.mode("overwrite").partitionBy(DAY)
    writer = writer.option(f"parquet.bloom.filter.enabled#{symbol}", "true")
    writer.option(f"parquet.bloom.filter.expected.ndv#{symbol}", str(symbols)).parquet(path)


def read_by_day(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored rows, given the schema they were written with, and their day."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])).parquet(path)


def history(stored: DataFrame, symbol: str, start=None, end=None, time: str = "time_stamp", key: str = "symbol_coin") -> DataFrame:
    """Rows of one symbol in ``[start, end)``, newest first; the time range is also one of days, for the folders."""
    rows = stored.where(F.col(key) == symbol)
    if start is not None:
        begin = F.lit(start).cast(stored.schema[time].dataType)
        rows = rows.where((F.col(time) >= begin) & (F.col(DAY) >= begin.cast("date")))
    if end is not None:
        stop = F.lit(end).cast(stored.schema[time].dataType)
        rows = rows.where((F.col(time) < stop) & (F.col(DAY) <= stop.cast("date")))
    return rows.drop(DAY).orderBy(F.col(time).desc())
