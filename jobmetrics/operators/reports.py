"""Reports on the hourly fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobmetrics.functions.values import ratio
from jobmetrics.operators.enrich import with_name

COUNTS = ["clicks", "conversion", "qualified_application", "disqualified_application"]
REPORT_COLUMNS = [
    "dates", "hours", "job_id", "publisher_id", "company_id", "campaign_id", "group_id",
    "clicks", "conversion", "qualified_application", "disqualified_application",
    "bid_set", "spend_hour",
]


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).alias(name)


def totals(fact: DataFrame, *keys: str) -> DataFrame:
    """Metrics summed over ``keys``; the bid is spend per click, never a mean of means."""
    summed = fact.groupBy(*keys).agg(
        *[_total(c) for c in COUNTS], F.coalesce(F.sum("spend_hour"), F.lit(0.0)).alias("spend")
    )
    return summed.withColumn("bid_set", ratio(F.col("spend"), F.col("clicks")))


def daily(fact: DataFrame, key: str) -> DataFrame:
    return totals(fact, key, "dates")


def funnel(fact: DataFrame, *keys: str) -> DataFrame:
    """How far candidates get: applications per click and the qualified share."""
    summed = totals(fact, *keys)
    judged = F.col("qualified_application") + F.col("disqualified_application")
    return summed.select(
        *keys,
        *COUNTS,
        ratio(F.col("conversion"), F.col("clicks")).alias("conversion_rate"),
        ratio(F.col("qualified_application"), judged).alias("qualified_share"),
        ratio(F.col("spend"), F.col("conversion")).alias("spend_per_conversion"),
    )


def latest_hours(fact: DataFrame, rows: int = 20) -> DataFrame:
    """The most recent cells. Ties at the cut are settled by the ids."""
    return (
        fact.select(*REPORT_COLUMNS)
        .orderBy(
            F.desc("dates"), F.desc("hours"), "job_id", "publisher_id", "campaign_id", "group_id"
        )
        .limit(rows)
    )


def by_dimension(fact: DataFrame, dimension: DataFrame, key: str, *columns: str) -> DataFrame:
    """Totals per dimension member with its columns; unknown members keep NULL columns.

    Summing comes first, so the join sees one row per member.
    """
    return with_name(totals(fact, key), dimension, key, *columns)


def spend_vs_budget(fact: DataFrame, campaign: DataFrame) -> DataFrame:
    spent = by_dimension(fact, campaign, "campaign_id", "campaign_name", "budget_total")
    return spent.select(
        "campaign_id",
        "campaign_name",
        "budget_total",
        "spend",
        (F.col("budget_total") - F.col("spend")).alias("budget_left"),
        ratio(F.col("spend"), F.col("budget_total")).alias("budget_share"),
    )
