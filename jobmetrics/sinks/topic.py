"""Events as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobmetrics import schemas


def events_to_json(events: DataFrame) -> DataFrame:
    """One ``value`` per event; missing fields are written as JSON null."""
    message = F.struct(*schemas.MESSAGE_FIELDS)
    return events.select(F.to_json(message, {"ignoreNullFields": "false"}).alias("value"))


def write_topic(events: DataFrame, servers: str, topic: str) -> None:
    """Needs Spark's Kafka package on the classpath."""
    writer = events_to_json(events).write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()
