"""The hourly fact: clean, aggregate once, add the company, name the columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobmetrics.operators.clean import ID_COLUMNS, all_whole, tracking_clean
from jobmetrics.operators.enrich import with_company
from jobmetrics.operators.metrics import hourly_metrics

# Fixed value: what the fact's `sources` column says about rows of the event table.
SOURCE_NAME = "Cassandra"

_RENAMED = {
    "date": "dates",
    "hour": "hours",
    "unqualified": "disqualified_application",
    "qualified": "qualified_application",
    "conversions": "conversion",
}
_IDS = ["job_id", "publisher_id", "company_id", "campaign_id", "group_id"]
FACT_COLUMNS = [
    "job_id", "dates", "hours", "publisher_id", "company_id", "campaign_id", "group_id",
    "disqualified_application", "qualified_application", "conversion", "clicks",
    "bid_set", "spend_hour", "sources",
]


def build_fact(
    tracking: DataFrame, job_dim: DataFrame, *extra: Column, source_name: str = SOURCE_NAME
) -> DataFrame:
    """Fact rows of all events given. ``extra`` adds aggregates to each cell.

    Cells with an id that is no whole number are left out; ``audit.rejected_ids`` lists them.
    """
    hourly = hourly_metrics(tracking_clean(tracking), *extra).filter(all_whole(ID_COLUMNS))
    named = with_company(hourly, job_dim).withColumnsRenamed(_RENAMED)
    ids = {name: F.col(name).cast("long") for name in _IDS}
    extras = [c for c in named.columns if c not in FACT_COLUMNS]
    return (
        named.withColumns(ids)
        .withColumn("sources", F.lit(source_name))
        .select(*FACT_COLUMNS, *extras)
    )
