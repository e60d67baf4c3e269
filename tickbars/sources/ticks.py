"""Tick messages from a Kafka topic or from landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickbars.schemas import TOPIC, TOPIC_FORMAT

#: No file is left out for its age.
ANY_AGE = "36500d"
MESSAGE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def read_topic_stream(
    spark: SparkSession, servers: str, topic: str = TOPIC, options: dict[str, str] | None = None
) -> DataFrame:
    """Messages of a Kafka topic; needs Spark's Kafka package on the class path.

    Offsets start where Kafka's source starts by default (the end of the topic) unless ``options`` says otherwise;
    ``maxOffsetsPerTrigger`` there bounds a batch after an outage.
    """
    reader = spark.readStream.format(TOPIC_FORMAT).option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.options(**(options or {})).load()


def read_message_files_stream(spark: SparkSession, path: str, *, files_per_batch: int | None = None) -> DataFrame:
    """The same key/value messages from a folder of parquet files."""
    reader = spark.readStream.schema(MESSAGE).option("maxFileAge", ANY_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_message_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE).parquet(path)
