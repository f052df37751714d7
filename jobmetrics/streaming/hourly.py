"""Hourly metrics kept up to date from the event stream.

Each batch of messages goes to the event lake first. Then the days it touches are computed anew
from the lake, where the last write per key counts, and replace their cells. No event is too
late, a message sent again replaces the earlier one, and the result is that of the batch form,
however the input is cut into batches. ``audit.late_rows`` tells which messages came late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from jobmetrics.operators.clean import tracking_clean
from jobmetrics.operators.metrics import CELL, hourly_metrics
from jobmetrics.sinks.fact_lake import replace_partitions
from jobmetrics.streaming import ingest
from jobmetrics.streaming.batch_log import ONCE

METRICS = ["bid_set", "clicks", "spend_hour", "conversions", "qualified", "unqualified"]
_LAYOUT = """
    job_id DOUBLE, hour INT, publisher_id DOUBLE, campaign_id DOUBLE, group_id DOUBLE,
    bid_set DOUBLE, clicks BIGINT, spend_hour DOUBLE, conversions BIGINT, qualified BIGINT,
    unqualified BIGINT, updated_at TIMESTAMP, dates DATE
"""


def refresh(spark: SparkSession, lake: str, path: str, batch_id: int) -> None:
    """Compute the days that a batch touches anew; doing it twice changes nothing."""
    days = ingest.touched_days(spark, lake, batch_id, batch_id - 1)
    if days:
        events = ingest.read_tracking(spark, lake, batch_id).filter(F.col("dates").isin(days))
        cells = hourly_metrics(tracking_clean(events.drop("dates"))).withColumnRenamed("date", "dates")
        replace_partitions(cells, path, days, _LAYOUT)


def start_hourly(
    messages: DataFrame, lake: str, path: str, trigger: dict = ONCE, compact_every: int = 0
) -> StreamingQuery:
    """Ingest messages into ``lake`` and keep the cells under ``path`` up to date."""
    return ingest.start_ingest(
        messages, lake, trigger, compact_every,
        then=lambda spark, batch_id: refresh(spark, lake, path, batch_id),
    )


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    cells = spark.read.schema(_LAYOUT).parquet(path).withColumnRenamed("dates", "date")
    return cells.select(*CELL, *METRICS)
