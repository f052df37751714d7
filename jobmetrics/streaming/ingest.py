"""Continuous ingest of event messages into the event lake.

Messages are appended as they come and the last write per key is chosen on reading. The
event day is part of the key, so a read of some days sees every version of their keys and
nothing else. Rewriting the touched days in every batch instead would make a late event cost
a day of data.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from jobmetrics import schemas
from jobmetrics.operators.upsert import latest_by_key
from jobmetrics.streaming import batch_log
from jobmetrics.streaming.batch_log import ONCE, read_log, start_log
from jobmetrics.streaming.decode import POSITION, decode_messages

_LAYOUT = (
    f"{schemas.MESSAGE}, received_at TIMESTAMP, offset BIGINT, partition INT, "
    "reject_reason STRING, raw STRING, outcome STRING, dates DATE"
)
PARTITIONS = ["outcome", "dates"]


def start_ingest(
    messages: DataFrame,
    path: str,
    trigger: dict = ONCE,
    compact_every: int = 0,
    then: Callable[[SparkSession, int], None] | None = None,
) -> StreamingQuery:
    """Write the stream to the lake: good rows by day, rejected ones apart, in one pass.

    Every ``compact_every``-th batch compacts the lake; 0 leaves that to ``compact``.
    """
    outcome = F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")
    decoded = decode_messages(messages).withColumn("outcome", outcome)

    def after(spark: SparkSession, batch_id: int) -> None:
        if then:
            then(spark, batch_id)
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact(spark, path)

    return start_log(decoded, path, PARTITIONS, trigger, then=after)


def compact(spark: SparkSession, path: str) -> bool:
    """Gather small batches by day, keeping of each key the last version; False if there are none."""

    def resolve(rows: DataFrame) -> DataFrame:
        good = latest_by_key(rows.filter("outcome = 'accepted'"), key=("dates", "create_time"))
        return good.unionByName(rows.filter("outcome <> 'accepted'"))

    return batch_log.compact(spark, path, _LAYOUT, PARTITIONS, resolve)


def read_versions(
    spark: SparkSession, path: str, upto: int | None = None, after: int = -1
) -> DataFrame:
    """Accepted messages, up to a batch and after one, with their ``batch`` and ``dates``.

    Versions of a key that a later one had replaced when the lake was compacted are gone.
    """
    rows = read_log(spark, path, _LAYOUT, upto, after).filter(F.col("outcome") == "accepted")
    return rows.select(*schemas.MESSAGE_FIELDS, "dates", *POSITION, "batch")


def touched_days(spark: SparkSession, path: str, upto: int, after: int) -> list[date]:
    """Days of the events that arrived in the batches after one, up to another.

    Plausible times bound them to one per calendar day since 1990 (see ``streaming.decode``).
    """
    days = read_versions(spark, path, upto, after).select("dates").distinct()
    return sorted(row["dates"] for row in days.collect())


def read_tracking(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """The event table: one row per key, the last one received; ``dates`` for pruning."""
    # The day follows from the key. Naming both lets a filter on the day pass the window.
    latest = latest_by_key(read_versions(spark, path, upto), key=("dates", "create_time"))
    return latest.select(*schemas.MESSAGE_FIELDS, "dates")


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    rows = read_log(spark, path, _LAYOUT).filter(F.col("outcome") == "rejected")
    return rows.select(*POSITION, "reject_reason", "raw")
