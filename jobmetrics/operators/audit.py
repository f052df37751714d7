"""Counts of what the metrics leave out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobmetrics.functions.time_uuid import is_time_uuid, uuid_to_ts
from jobmetrics.operators.clean import (
    EVENT_TYPES, ID_COLUMNS, all_whole, is_whole, of_known_type, tracking_clean,
)


def unrecognized_events(clean: DataFrame) -> DataFrame:
    """Events of a type that is not counted, also of none, per type."""
    known = F.coalesce(F.col("custom_track").isin(EVENT_TYPES), F.lit(False))
    return clean.filter(~known).groupBy("custom_track").agg(F.count("*").alias("events"))


def key_audit(rows: DataFrame) -> DataFrame:
    """Rows per state of their key: ``time_uuid``, ``not_time_uuid`` or ``missing``."""
    key = F.col("create_time")
    state = (
        F.when(key.isNull(), "missing")
        .when(is_time_uuid(key), "time_uuid")
        .otherwise("not_time_uuid")
    )
    return rows.groupBy(state.alias("key_state")).agg(F.count("*").alias("row_count"))


def rejected_ids(clean: DataFrame) -> DataFrame:
    """Counted events that the fact leaves out for an id that is no whole number, per ids.

    ``reason`` names the columns at fault.
    """
    seen = of_known_type(clean).groupBy(*ID_COLUMNS).agg(F.count("*").alias("events"))
    faults = [F.when(~is_whole(c), c) for c in ID_COLUMNS]
    return seen.filter(~all_whole(ID_COLUMNS)).withColumn("reason", F.concat_ws(",", *faults))


def late_rows(versions: DataFrame, late: str = "2 hours", ahead: str = "1 hour") -> DataFrame:
    """Messages received long after their event, or before it, with the reason.

    Nothing is left out of the metrics for it; this tells how far hours still change.
    """
    event, received = uuid_to_ts(F.col("create_time")), F.col("received_at")
    reason = F.when(received > event + F.expr(f"INTERVAL {late}"), "late").when(
        event > received + F.expr(f"INTERVAL {ahead}"), "ahead"
    )
    found = versions.withColumn("reason", reason).filter(F.col("reason").isNotNull())
    return found.select("offset", "partition", "create_time", "reason")


def stale_days(tracking: DataFrame, fact: DataFrame) -> DataFrame:
    """Days on which the events and the fact disagree on the number of counted events.

    For loads that look back a limited time: the days that late events have reached since.
    """
    kept = of_known_type(tracking_clean(tracking)).filter(all_whole(ID_COLUMNS))
    events = kept.groupBy(F.to_date("ts").alias("dates")).agg(F.count("*").alias("events"))
    counts = ["clicks", "conversion", "qualified_application", "disqualified_application"]
    loaded = fact.groupBy("dates").agg(
        sum((F.coalesce(F.sum(c), F.lit(0)) for c in counts), F.lit(0)).cast("long").alias("loaded")
    )
    both = events.join(loaded, "dates", "full").na.fill(0, ["events", "loaded"])
    return both.filter(F.col("events") != F.col("loaded"))
