"""The hourly fact as Parquet, one partition per day."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobmetrics import schemas
from jobmetrics.sinks.files import remove
from jobmetrics.sources.tables import read_if_present


def _stored(fact: DataFrame, stamp: Column) -> DataFrame:
    """The declared columns, stamped with the load time unless the rows carry one."""
    if "updated_at" not in fact.columns:
        fact = fact.withColumn("updated_at", stamp)
    return fact.select(*schemas.column_names(schemas.FACT))


def _by_day(rows: DataFrame):
    # Rebalancing gathers a day's rows into few files and still splits a day that is too big
    # for one task; a plain repartition by day could do only the first.
    return rows.hint("rebalance", "dates").write.partitionBy("dates")


def replace_fact(fact: DataFrame, path: str) -> None:
    """Replace the whole table."""
    _by_day(_stored(fact, F.current_timestamp())).mode("overwrite").parquet(path)


def replace_days(fact: DataFrame, path: str, days: Collection[date] = ()) -> None:
    """Replace the days present in ``fact``, and remove those of ``days`` that are not.

    All other days stay; writing twice changes nothing.
    """
    replace_partitions(_stored(fact.drop("updated_at"), F.lit(None)), path, days, schemas.FACT)


def replace_partitions(rows: DataFrame, path: str, days: Collection[date], layout: str) -> None:
    """``replace_days`` for any table by ``dates`` with a column ``updated_at``, which is set."""
    spark = rows.sparkSession
    now = spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
    stamped = rows.withColumn("updated_at", F.timestamp_micros(F.lit(now)))
    writer = _by_day(stamped).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    stored = read_if_present(spark, path, layout)
    if not days or stored is None:
        return
    # A day that got rows has all of them from this write.
    old = stored.filter(F.col("dates").isin(list(days))).groupBy("dates").agg(
        F.unix_micros(F.max("updated_at")).alias("at")
    )
    for row in old.filter(F.col("at") != now).collect():
        remove(spark, f"{path}/dates={row['dates']}")
    spark.catalog.refreshByPath(path)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FACT).parquet(path)
