"""The event topic. Needs Spark's Kafka package on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# What a query reads from: one of these options of the source.
SUBSCRIPTIONS = {"subscribe", "subscribePattern", "assign"}


def topic_options(servers: str, topic: str | None = None, **options: str) -> dict[str, str]:
    """The source's options. Those given win over the defaults.

    Progress is kept in the query's checkpoint; ``startingOffsets`` (``earliest`` unless given)
    applies to the first run.
    """
    own = {"kafka.bootstrap.servers": servers, "startingOffsets": "earliest"}
    if topic is not None:
        own["subscribe"] = topic
    if own.keys() & SUBSCRIPTIONS and options.keys() & SUBSCRIPTIONS - {"subscribe"}:
        raise ValueError("give a topic, or subscribePattern, or assign")
    merged = own | options
    if not merged.keys() & SUBSCRIPTIONS:
        raise ValueError("give a topic, subscribePattern or assign")
    return merged


def read_topic(
    spark: SparkSession, servers: str, topic: str | None = None, **options: str
) -> DataFrame:
    """Stream of messages with their place in the topic, as ``streaming.decode`` takes them."""
    raw = spark.readStream.format("kafka").options(**topic_options(servers, topic, **options)).load()
    return raw.select("value", F.col("timestamp").alias("received_at"), "offset", "partition")
