"""From raw tracking rows to rows that can be counted."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from jobmetrics.functions.time_uuid import is_time_uuid, time_of, uuid_to_ts

# The event types that are counted, and the ids whose gaps become 0.
EVENT_TYPES = ["click", "conversion", "qualified", "unqualified"]
ID_COLUMNS = ["job_id", "publisher_id", "group_id", "campaign_id"]


def decode_events(tracking: DataFrame) -> DataFrame:
    """Add ``ts``, the event time held in the key; NULL for keys that hold none."""
    return tracking.withColumn("ts", uuid_to_ts(F.col("create_time")))


def tracking_clean(tracking: DataFrame) -> DataFrame:
    """Decoded events that belong to a job, with missing ids set to 0.

    The job filter runs first, so a NULL job drops the row while a NaN job becomes job 0.
    ``na.fill`` replaces NaN as well as NULL. A bid counts only on a click.
    """
    key = F.col("create_time")
    # Filtering on the key's form, not on the decoded time: Spark would move that filter below
    # the decoding and so decode twice.
    kept = tracking.filter(F.col("job_id").isNotNull() & is_time_uuid(key))
    filled = kept.withColumn("ts", time_of(key)).na.fill(0, ID_COLUMNS)
    click_bid = F.coalesce(F.nanvl("bid", F.lit(None).cast("double")), F.lit(0.0))
    return filled.withColumn(
        "bid", F.when(F.col("custom_track") == "click", click_bid).otherwise(F.col("bid"))
    )


def of_known_type(events: DataFrame) -> DataFrame:
    return events.filter(F.col("custom_track").isin(EVENT_TYPES))


def is_whole(column: str) -> Column:
    """Whether a number is a whole one that fits an id: no fraction, not infinite, not beyond BIGINT."""
    x = F.col(column)
    return F.coalesce(x.try_cast("long").cast("double") == x, F.lit(False))


def all_whole(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [is_whole(c) for c in columns])


def tracking_summary(tracking: DataFrame) -> DataFrame:
    """Five-column extract of the event table; ids that are no integer become NULL."""
    return tracking.select(
        "create_time",
        "bid",
        "bn",
        F.col("campaign_id").try_cast("int").alias("campaign_id"),
        F.col("cd").try_cast("int").alias("cd"),
    )
