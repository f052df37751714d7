"""Joins to the dimensions.

No join carries a broadcast hint. Spark broadcasts a dimension while its size is known to be
under ``spark.sql.autoBroadcastJoinThreshold`` (from file statistics, or measured at run time
by adaptive execution for sources without statistics). Beyond that it sorts and merges, and
adaptive execution splits a key that holds too many rows. All joins come after aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def job_dimension(job: DataFrame) -> DataFrame:
    """The four columns of the job table the pipeline uses, keyed ``job_id``."""
    return job.select(F.col("id").alias("job_id"), "company_id", "group_id", "campaign_id")


def with_company(hourly: DataFrame, job_dim: DataFrame) -> DataFrame:
    """Add the job's company; cells of unknown jobs keep a NULL company.

    Campaign and group stay those of the events, the job's own are not taken. Event ids are
    doubles, so the integer key is widened instead of cutting the event's id.
    """
    company = job_dim.select(F.col("job_id").cast("double").alias("job_id"), "company_id")
    return hourly.join(company, "job_id", "left")


def with_name(facts: DataFrame, dimension: DataFrame, key: str, *columns: str) -> DataFrame:
    """Add columns of a dimension (keyed ``id``) to rows that carry its ``key``."""
    wanted = dimension.select(F.col("id").alias(key), *columns)
    return facts.join(wanted, key, "left")


def id_mismatch(clean: DataFrame, job_dim: DataFrame) -> DataFrame:
    """How many events name another campaign or group than their job does.

    Events are counted per id combination first, so the join sees few rows per job.
    """
    seen = clean.groupBy("job_id", "campaign_id", "group_id").agg(F.count("*").alias("events"))
    job = job_dim.select(
        F.col("job_id").cast("double").alias("job_id"),
        F.col("campaign_id").cast("double").alias("job_campaign_id"),
        F.col("group_id").cast("double").alias("job_group_id"),
    )
    same = F.col("campaign_id").eqNullSafe(F.col("job_campaign_id")) & F.col(
        "group_id"
    ).eqNullSafe(F.col("job_group_id"))
    return seen.join(job, "job_id").filter(~same)
