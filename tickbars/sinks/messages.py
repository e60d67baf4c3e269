"""Keyed JSON messages to a Kafka topic or to files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickbars.functions.messages import to_messages
from tickbars.schemas import TOPIC, TOPIC_FORMAT


def publish_to_topic(ticks: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Send one message per tick; needs Spark's Kafka package on the class path."""
    writer = to_messages(ticks).write.format(TOPIC_FORMAT).mode("append").option("kafka.bootstrap.servers", servers)
    writer.option("kafka.acks", "all").option("topic", topic).save()


def publish_to_files(ticks: DataFrame, path: str) -> None:
    to_messages(ticks).write.mode("overwrite").parquet(path)
