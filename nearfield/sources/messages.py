"""Streams of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_KEPT = ("topic", "partition", "offset")


def kafka_messages(spark: SparkSession, brokers: str, topics: str, **options) -> DataFrame:
    """Messages of one or several topics (comma-separated), as ``value`` text and their origin.

    Needs the Kafka connector package on the cluster.
    """
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers).option("subscribe", topics)
    return message_values(stream.options(**options).load())


def text_messages(spark: SparkSession, path: str, **options) -> DataFrame:
    """Messages from a folder of text files, one per line."""
    return message_values(spark.readStream.format("text").options(**options).load(path))


def message_values(messages: DataFrame) -> DataFrame:
    """The value as text, with topic, partition and offset where the source has them."""
    origin = [c for c in _KEPT if c in messages.columns]
    return messages.select(F.col("value").cast("string").alias("value"), *origin)
