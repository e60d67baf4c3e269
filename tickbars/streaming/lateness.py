"""Late ticks kept.

Spark drops a tick that comes after the watermark without a word, and which ticks those are depends on how a query's
micro-batches happened to be cut. Here the landing step writes down, beside every tick, the newest event time of all
batches before its own: the high-water mark. From it each query tells by its own delay and windows which windows of a
tick were closed when it came. Such windows do not get the tick, and the tick is read back from the landing folder as
rejected, with the reason and the number of windows missed. The result depends on the landed batches alone; later
micro-batches may take several of them at once.

A batch is written under a hidden name and renamed when it is whole, so a reader sees all of it or nothing, and a batch
that is repeated after a failure is left alone if it is there. Marks are kept beside the batches, one small file each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickbars.functions.messages import EARLIEST, LATEST
from tickbars.operators.rolling import microseconds, rolling_stats
from tickbars.schemas import POLL_INTERVAL, SLIDE_DURATION, TICK, WATERMARK, WINDOW_DURATION
from tickbars.session import make_folder
from tickbars.sources.ticks import ANY_AGE
from tickbars.streaming.landing import LANDED, landed_rows

BATCH, HIGH_WATER = "batch_id", "high_water"
#: Folder columns last and in the order of the folders: a stream that starts on an empty folder keeps this order.
MARKED = T.StructType(
    [*LANDED.fields[:-1], T.StructField(HIGH_WATER, T.TimestampType()), T.StructField(BATCH, T.LongType()), LANDED["rejected"]]
)
LATE, LATE_IN_PART = "late", "late in part"


class _Folder:
    """The batches and marks of one landing folder, through Spark's own file system client."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark._jvm, path.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def batch(self, number: int) -> str:
        return f"{BATCH}={number}"

    def has(self, number: int) -> bool:
        return self.fs.exists(self._path(self.batch(number)))

    def publish(self, staged: str, number: int) -> None:
        if not self.fs.rename(self._path(staged), self._path(self.batch(number))):
            raise OSError(f"{staged} of {self.path} could not be renamed")

    def mark_before(self, number: int) -> int | None:
        """The mark that the newest batch before this one left, in microseconds."""
        found = self.fs.globStatus(self._path("_marks/*")) or []
        names = [status.getPath().getName().split("=") for status in found]
        earlier = [(int(batch), mark) for batch, mark in names if int(batch) < number]
        mark = max(earlier)[1] if earlier else "none"
        return None if mark == "none" else int(mark)

    def mark(self, number: int, micros: int | None) -> None:
        """A mark is the name of an empty file, which a store creates as a whole or not at all. Only the one before, which a
        repeated batch needs, is kept beside it."""
        for status in self.fs.globStatus(self._path("_marks/*")) or []:
            if int(status.getPath().getName().split("=")[0]) not in (number - 1, number - 2):
                self.fs.delete(status.getPath(), False)
        self.fs.create(self._path(f"_marks/{number}={'none' if micros is None else micros}"), True).close()


def land_ticks_marked(
    messages: DataFrame, path: str, checkpoint: str, *, earliest: str = EARLIEST, latest: str = LATEST, **trigger
) -> StreamingQuery:
    """``land_ticks`` with the high-water mark of the earlier batches on every row."""
    make_folder(messages.sparkSession, f"{path.rstrip('/')}/_marks")

    def land(batch: DataFrame, number: int) -> None:
        folder = _Folder(batch.sparkSession, path)
        if folder.has(number):
            return
        before = folder.mark_before(number)
        mark = F.timestamp_micros(F.lit(before).cast("long"))
        rows = landed_rows(batch, earliest, latest).withColumn(HIGH_WATER, mark)
        seen = Observation()
        newest = F.max(F.when(~F.col("rejected"), F.unix_micros("time_stamp"))).alias("newest")
        staged = f"_staged-{number}"
        rows.observe(seen, newest).write.mode("overwrite").partitionBy("rejected").parquet(f"{folder.path}/{staged}")
        known = [micros for micros in (before, seen.get["newest"]) if micros is not None]
        folder.mark(number, max(known, default=None))
        folder.publish(staged, number)

    writer = messages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": POLL_INTERVAL})).start()


def _accepted(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("rejected")).select(*TICK.fieldNames(), HIGH_WATER)


def read_marked_stream(spark: SparkSession, path: str) -> DataFrame:
    """Accepted ticks with their marks as a stream. A micro-batch takes whole landed batches, all there are: split ones
    would let the query's own watermark overtake the marks."""
    return _accepted(spark.readStream.schema(MARKED).option("maxFileAge", ANY_AGE).parquet(path))


def read_marked(spark: SparkSession, path: str) -> DataFrame:
    return _accepted(spark.read.schema(MARKED).parquet(path))


def closed_by(watermark: str = WATERMARK) -> Column:
    """The time by which windows were closed when the tick came; NULL in the first batch."""
    return F.timestamp_micros(F.unix_micros(HIGH_WATER) - microseconds(watermark))


def rolling_on_time_stream(
    ticks: DataFrame, watermark: str = WATERMARK, duration: str = WINDOW_DURATION, slide: str = SLIDE_DURATION
) -> DataFrame:
    """Window statistics of marked ticks without the windows each tick was too late for.

    The query's own watermark closes windows and frees their state. It never runs ahead of the marks: what a micro-batch
    has seen before is part of what had landed before.
    """
    watched = ticks.withWatermark("time_stamp", watermark)
    return rolling_stats(watched, duration, slide, closed=closed_by(watermark))


def late_ticks(
    ticks: DataFrame, watermark: str = WATERMARK, duration: str = WINDOW_DURATION, slide: str = SLIDE_DURATION
) -> DataFrame:
    """Marked ticks that came too late for some of their windows, with ``missed_windows`` and the reason: ``late`` if all
    were closed, so that the tick is in no result, else ``late in part``. No shuffle, and no state on a stream."""
    length, step = microseconds(duration), microseconds(slide)
    time, closed = F.unix_micros("time_stamp"), F.unix_micros(closed_by(watermark))
    last_end = time - F.pmod(time, F.lit(step)) + length
    # Windows that end after the tick, from the last one backwards.
    windows = F.ceil((last_end - time) / step)
    first_end = last_end - (windows - 1) * step
    missed = F.least(windows, F.greatest(F.lit(0), F.floor((closed - first_end) / step) + 1))
    found = ticks.withColumns({"missed_windows": F.when(closed.isNotNull(), missed).cast("long"), "windows": windows})
    reason = F.when(F.col("missed_windows") == F.col("windows"), LATE).otherwise(LATE_IN_PART)
    return found.where("missed_windows > 0").withColumn("reject_reason", reason).drop("windows")
