"""One shared step that reads and parses the messages for all queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickbars.functions.messages import EARLIEST, LATEST, parse_ticks, reject_reason
from tickbars.schemas import POLL_INTERVAL, TICK
from tickbars.session import make_folder
from tickbars.sources.ticks import ANY_AGE

LANDED = T.StructType(
    [
        *TICK.fields,
        T.StructField("raw", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)


def landed_rows(messages: DataFrame, earliest: str = EARLIEST, latest: str = LATEST) -> DataFrame:
    """Parsed ticks with their reject reason; rejected ones keep the raw text."""
    text = messages.select(F.col("value").cast("string").alias("value"))
    ticks = parse_ticks(text, keep=("value",)).withColumn("reject_reason", reject_reason(earliest, latest))
    rejected = F.col("reject_reason").isNotNull()
    return ticks.select(
        *TICK.fieldNames(),
        F.when(rejected, F.col("value")).alias("raw"),
        "reject_reason",
        rejected.alias("rejected"),
    )


def accepted_ticks(messages: DataFrame, earliest: str = EARLIEST, latest: str = LATEST) -> DataFrame:
    """Parsed ticks without the rejected ones, for a query that reads the messages itself."""
    return parse_ticks(messages).where(reject_reason(earliest, latest).isNull())


def land_ticks(
    messages: DataFrame, path: str, checkpoint: str, *, earliest: str = EARLIEST, latest: str = LATEST, **trigger
) -> StreamingQuery:
    """Stream messages into a parquet folder, each batch exactly once, rejected ticks in a partition of their own."""
    make_folder(messages.sparkSession, path)  # readers may start before the first batch is in
    writer = landed_rows(messages, earliest, latest).writeStream.outputMode("append").format("parquet").partitionBy("rejected")
    writer = writer.option("checkpointLocation", checkpoint).option("path", path)
    return writer.trigger(**(trigger or {"processingTime": POLL_INTERVAL})).start()


def read_landed_stream(
    spark: SparkSession, path: str, *, files_per_batch: int | None = None, max_file_age: str = ANY_AGE
) -> DataFrame:
    """Accepted ticks of the landing folder as a stream.

    Spark skips files that are older than the newest one by more than ``max_file_age``, without a word, so the default
    is an age that no file has; what it costs is one remembered path per file on the driver.
    """
    reader = spark.readStream.schema(LANDED).option("maxFileAge", max_file_age)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).where(~F.col("rejected")).select(*TICK.fieldNames())


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Accepted ticks of the landing folder as a table."""
    return spark.read.schema(LANDED).parquet(path).where(~F.col("rejected")).select(*TICK.fieldNames())


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Rejected messages with the reason."""
    return spark.read.schema(LANDED).parquet(path).where("rejected").select("raw", "reject_reason")
