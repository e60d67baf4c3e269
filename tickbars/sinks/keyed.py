"""Keyed tables on plain parquet: the newest write of a key wins.

A table is a folder of batches, ``log/batch_id=N``. Writing a batch again replaces its folder, so a retry changes
nothing, and only batches with Spark's commit marker are read. ``compacted/batch_id=N`` holds the table as of batch N.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tickbars.operators.live import latest_per_key, newest_per_key
from tickbars.schemas import ResultTable

BATCH = "batch_id"


def _file_system(spark: SparkSession, folder: str):
    """Spark's own file system client, so that any store Spark can write works here too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _committed(spark: SparkSession, folder: str) -> list[int]:
    """Batch numbers under ``folder`` whose write was committed; reads the folder listing only."""
    path, fs = _file_system(spark, f"{folder}/{BATCH}=*/_SUCCESS")
    return sorted(int(m.getPath().getParent().getName().split("=")[1]) for m in fs.globStatus(path) or [])


@dataclass(frozen=True)
class KeyedTable:
    """One result table under ``path``, written by one job or streaming query only."""

    contract: ResultTable
    path: str
    schema: T.StructType

    @classmethod
    def like(cls, df: DataFrame, contract: ResultTable, path: str) -> KeyedTable:
        """The table for results shaped like ``df``."""
        return cls(contract, path.rstrip("/"), df.select(*contract.columns).schema)

    @classmethod
    def open(cls, spark: SparkSession, contract: ResultTable, path: str) -> KeyedTable:
        """An existing table, its types taken from its newest batch."""
        path = path.rstrip("/")
        newest = _committed(spark, f"{path}/log")[-1]
        stored = spark.read.parquet(f"{path}/log/{BATCH}={newest}")
        return cls.like(stored, contract, path)

    @property
    def checkpoint(self) -> str:
        """A stream's progress lives with its table: batch numbers of one mean nothing beside the other's."""
        return f"{self.path}/checkpoint"

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Store one batch; the same ``batch_id`` again replaces it, unless it has become part of a compacted folder.

        Compaction leaves the newest batch alone, so a stream can always repeat the one batch it may have to.
        """
        spark = df.sparkSession
        if batch_id <= self._last_compacted(spark):
            raise ValueError(f"batch {batch_id} of {self.path} is compacted and cannot be replaced; use a new number")
        rows = df.select(*self.contract.columns)
        rows.write.mode("overwrite").parquet(f"{self.path}/log/{BATCH}={batch_id}")

    def _read(self, spark: SparkSession, kind: str, batches: list[int]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())])
        if not batches:
            return spark.createDataFrame([], schema)
        base = f"{self.path}/{kind}"
        reader = spark.read.schema(schema).option("basePath", base)
        return reader.parquet(*[f"{base}/{BATCH}={b}" for b in batches])

    def _last_compacted(self, spark: SparkSession) -> int:
        done = _committed(spark, f"{self.path}/compacted")
        return done[-1] if done else -1

    def log(self, spark: SparkSession, after: int = -1, upto: int | None = None) -> DataFrame:
        """Every committed row with its batch, later versions of a key included."""
        batches = _committed(spark, f"{self.path}/log")
        return self._read(spark, "log", [b for b in batches if b > after and (upto is None or b <= upto)])

    def latest(self, spark: SparkSession, key_filter: Column | None = None, upto: int | None = None) -> DataFrame:
        """The newest row of each key, by batch and then by the row's own values.

        Compacted rows are unique already, so they only lose the keys that newer batches wrote again; while those
        batches are few Spark sends their keys around instead of shuffling the compacted table. ``key_filter``, a
        condition on key columns, limits every scan involved; a condition on the result cannot reach all of them.
        """
        keys = list(self.contract.keys)
        if key_filter is not None:
            # Filtering other columns before the newest row is known would bring back older rows: refuse to.
            spark.createDataFrame([], T.StructType([self.schema[key] for key in keys])).where(key_filter)

        def kept(rows: DataFrame) -> DataFrame:
            return rows if key_filter is None else rows.where(key_filter)

        compacted = self._last_compacted(spark)
        if upto is not None and upto < compacted:
            raise ValueError(f"batch {compacted} of {self.path} is compacted; the state as of batch {upto} is gone")
        recent = kept(self.log(spark, compacted, upto))
        # A lookup has few rows; over all of them nothing but ties is sorted.
        recent = newest_per_key(recent, keys, BATCH) if key_filter is None else latest_per_key(recent, keys, [BATCH])
        if compacted < 0:
            return recent.drop(BATCH)
        older, newer = kept(self._read(spark, "compacted", [compacted])), recent.select(*keys)
        # Null-safe: a board may hold a coin whose change, a key column there, is unknown.
        same_key = reduce(and_, [older[key].eqNullSafe(newer[key]) for key in keys])
        return older.join(newer, same_key, "left_anti").select(*recent.columns).unionByName(recent).drop(BATCH)

    def compact(self, spark: SparkSession) -> int:
        """Write the table as of its last batch but one as one folder, and return that batch's number.

        The folder is ordered by key, so that a lookup skips most files, and readers use it from the moment its commit
        marker exists. The range partitioning splits a hot value of a key column by the next key column.
        """
        done = self._last_compacted(spark)
        target = max(_committed(spark, f"{self.path}/log")[:-1], default=-1)
        if target <= done:
            return done
        keys = list(self.contract.keys)
        rows = self.latest(spark, upto=target).repartitionByRange(*keys).sortWithinPartitions(*keys)
        rows.write.mode("overwrite").parquet(f"{self.path}/compacted/{BATCH}={target}")
        return target

    def drop_compacted(self, spark: SparkSession) -> None:
        """Delete what the newest compacted folder has replaced.

        For maintenance windows: a query that is still reading an older state of the table would miss its files.
        """
        last = self._last_compacted(spark)
        replaced = [("log", b) for b in _committed(spark, f"{self.path}/log") if b <= last]
        replaced += [("compacted", b) for b in _committed(spark, f"{self.path}/compacted") if b < last]
        for kind, batch in replaced:
            path, fs = _file_system(spark, f"{self.path}/{kind}/{BATCH}={batch}")
            fs.delete(path, True)

    def snapshots(self, spark: SparkSession) -> DataFrame:
        """Rows of a board table with the batch that emitted them as ``snapshot_id``."""
        return self.log(spark).withColumnRenamed(BATCH, "snapshot_id")

    def last_snapshot(self, spark: SparkSession) -> DataFrame:
        """The board as its newest batch left it; reads that batch alone."""
        newest = _committed(spark, f"{self.path}/log")[-1:]
        return self._read(spark, "log", newest).withColumnRenamed(BATCH, "snapshot_id")
