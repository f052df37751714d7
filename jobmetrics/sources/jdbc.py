"""Reads from the warehouse over JDBC.

Subqueries run inside the database, so only their result crosses the network.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    driver: str
    user: str
    password: str = ""

    def options(self, **extra: str) -> dict[str, str]:
        login = {
            "url": self.url, "driver": self.driver, "user": self.user, "password": self.password,
        }
        return {**login, **extra}


@dataclass(frozen=True)
class Split:
    """Range of a numeric column to read a table in ``parts`` parallel queries.

    Rows outside the bounds are still read: the bounds only place the cuts.
    """

    column: str
    lower: int
    upper: int
    parts: int


def subquery_options(target: JdbcTarget, query: str, split: Split | None = None) -> dict[str, str]:
    options = target.options(dbtable=f"({query}) t", fetchsize="10000")
    if split:
        options.update(
            partitionColumn=split.column,
            lowerBound=str(split.lower),
            upperBound=str(split.upper),
            numPartitions=str(split.parts),
        )
    return options


def read_subquery(
    spark: SparkSession, target: JdbcTarget, query: str, split: Split | None = None
) -> DataFrame:
    return spark.read.format("jdbc").options(**subquery_options(target, query, split)).load()


def dimension_query(table: str, key: str, *columns: str) -> str:
    """The wanted columns of a dimension, its ``id`` under the name the facts use."""
    return f"SELECT {', '.join([f'id AS {key}', *columns])} FROM {table}"


def newest_query(table: str, column: str) -> str:
    return f"SELECT MAX({column}) AS max_ts FROM {table}"


def read_job_dimension(
    spark: SparkSession, target: JdbcTarget, split: Split | None = None
) -> DataFrame:
    query = dimension_query("job", "job_id", "company_id", "group_id", "campaign_id")
    return read_subquery(spark, target, query, split)


def read_fact_watermark(spark: SparkSession, target: JdbcTarget) -> DataFrame:
    return read_subquery(spark, target, newest_query("events", "updated_at"))
