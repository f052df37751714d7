"""Scans through any Spark table format.

The format is configuration: ``parquet`` with a path for the lake,
``org.apache.spark.sql.cassandra`` with ``keyspace`` and ``table`` for an event store
reached through its connector.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmetrics.functions.time_uuid import uuid_to_ts

# The columns of the event table the batch job works on.
TRACKING_COLUMNS = [
    "create_time", "job_id", "custom_track", "bid", "campaign_id", "group_id", "publisher_id",
]


@dataclass(frozen=True)
class Table:
    """Where a table lives and how to read it."""

    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    schema: str | None = None

    def load(self, spark: SparkSession, columns: Sequence[str] = ()) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        if self.schema:
            reader = reader.schema(self.schema)
        df = reader.load()
        return df.select(*columns) if columns else df


def cassandra_table(keyspace: str, table: str) -> Table:
    """Needs the connector on the classpath and ``spark.cassandra.connection.host`` set."""
    return Table("org.apache.spark.sql.cassandra", {"keyspace": keyspace, "table": table})


def read_if_present(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A Parquet table, None where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def tracking_scan(tracking: DataFrame) -> DataFrame:
    """Only the columns the job needs, so that the scan reads no others."""
    return tracking.select(*TRACKING_COLUMNS)


def latest_event_time(tracking: DataFrame) -> DataFrame:
    """One row: the newest event time. The keys are decoded first, their text is not ordered."""
    return tracking.select(uuid_to_ts(F.col("create_time")).alias("ts")).agg(
        F.max("ts").alias("max_ts")
    )


def publisher_ids(publisher: DataFrame) -> DataFrame:
    return publisher.select(F.col("id").alias("publisher_id")).distinct()


def group_ids(job: DataFrame) -> DataFrame:
    """The group of every job that has one."""
    return job.filter(F.col("group_id").isNotNull()).select(F.col("group_id").cast("int"))
