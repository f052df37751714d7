"""Hourly metrics per job, publisher, campaign and group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from jobmetrics.functions.values import null_if_zero
from jobmetrics.operators.clean import of_known_type

CELL = ["job_id", "date", "hour", "publisher_id", "campaign_id", "group_id"]


def _cell_columns() -> list[Column]:
    derived = {"date": F.to_date("ts"), "hour": F.hour("ts")}
    return [derived.get(name, F.col(name)).alias(name) for name in CELL]


def _is(event_type: str) -> Column:
    return F.col("custom_track") == event_type


def hourly_clicks(clean: DataFrame) -> DataFrame:
    """Average bid, number and spend of the clicks in each cell."""
    return (
        clean.filter(_is("click"))
        .groupBy(*_cell_columns())
        .agg(
            F.avg("bid").alias("bid_set"),
            F.count("*").alias("clicks"),
            F.sum("bid").alias("spend_hour"),
        )
    )


def hourly_count(clean: DataFrame, event_type: str, name: str) -> DataFrame:
    """Number of events of one type in each cell."""
    return clean.filter(_is(event_type)).groupBy(*_cell_columns()).agg(F.count("*").alias(name))


def metric_columns() -> list[Column]:
    """All metrics of a cell as conditional aggregates.

    A metric without events is NULL, not 0. The average bid is derived from sum and count,
    which every click takes part in, so cells can be merged exactly.
    """
    spend = F.sum(F.when(_is("click"), F.col("bid")))
    clicks = null_if_zero(F.count_if(_is("click")))
    return [
        (spend / clicks).alias("bid_set"),
        clicks.alias("clicks"),
        spend.alias("spend_hour"),
        null_if_zero(F.count_if(_is("conversion"))).alias("conversions"),
        null_if_zero(F.count_if(_is("qualified"))).alias("qualified"),
        null_if_zero(F.count_if(_is("unqualified"))).alias("unqualified"),
    ]


def hourly_metrics(clean: DataFrame, *extra: Column) -> DataFrame:
    """All metrics of each cell from one scan and one shuffle.

    Rows are combined before the shuffle, so a job, source or hour that holds a large share
    of the events sends one row per cell and task, whatever its size.
    """
    return of_known_type(clean).groupBy(*_cell_columns()).agg(*metric_columns(), *extra)


def hourly_metrics_joined(clean: DataFrame) -> DataFrame:
    """The same table from one aggregate per event type and full outer joins on the cell.

    Kept to check ``hourly_metrics``: it scans the events once per type.
    """
    parts = [
        hourly_clicks(clean),
        hourly_count(clean, "conversion", "conversions"),
        hourly_count(clean, "qualified", "qualified"),
        hourly_count(clean, "unqualified", "unqualified"),
    ]
    return reduce(lambda left, right: left.join(right, CELL, "full"), parts)
