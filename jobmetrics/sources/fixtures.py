"""Representative inputs derived from the given star-schema tables (see FIXTURES.md).

Everything is a projection of the given tables, so its size grows with them. A third of the
events belong to one job and share its hourly cells; the others spread over all members of
each dimension and a few beyond. Every column has gaps, and some ids are no whole numbers or
beyond 32 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobmetrics.functions.time_uuid import ts_to_uuid
from jobmetrics.functions.values import second_text
from jobmetrics.schemas import MESSAGE_FIELDS

EVENT_TYPE_OF = {
    "click": "click", "purchase": "conversion", "signup": "qualified", "error": "unqualified",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream, whether it is one file or a folder of files."""
    schema = events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def _gap(modulus: int, value: Column) -> Column:
    return F.when(F.col("event_id") % modulus != 0, value)


def tracking(events: DataFrame) -> DataFrame:
    """Event-table rows, plus ``event_id`` and ``event_ts`` for checks."""
    event_ts = F.col("ts").cast("timestamp")
    # props is always {"k": <number>}; a pattern reads it several times faster than a parser.
    k = F.regexp_extract("props", r'"k": *([0-9]+)', 1).try_cast("int")
    track = F.col("event_type")
    for name, event_type in EVENT_TYPE_OF.items():
        track = F.when(F.col("event_type") == name, event_type).otherwise(track)
    event, user, hot = F.col("event_id"), F.col("user_id"), F.col("event_id") % 3 == 0

    def id_of(gap: int, of_hot: Column, other: Column) -> Column:
        return _gap(gap, F.when(hot, of_hot).otherwise(other)).cast("double")

    job = id_of(97, F.lit(1), F.floor(event * 16 / 100))
    odd = F.when(event % 211 == 0, 0.5).when(event % 223 == 0, 3e9).otherwise(0.0)
    return events.select(
        "event_id",
        event_ts.alias("event_ts"),
        ts_to_uuid(event_ts, F.col("event_id")).alias("create_time"),
        (job + odd).alias("job_id"),
        id_of(53, k % 2, F.floor(event * 11 / 1000)).alias("publisher_id"),
        id_of(41, user % 3, F.floor(event * 21 / 100)).alias("campaign_id"),
        id_of(31, user % 2, event % 6).alias("group_id"),
        _gap(29, F.col("value")).alias("bid"),
        track.alias("custom_track"),
        second_text(event_ts).alias("ts"),
        F.concat(F.lit("b"), F.col("user_id") % 4).alias("bn"),
        (F.col("event_id") % 7).cast("double").alias("cd"),
    )


def messages(tracking: DataFrame) -> DataFrame:
    """JSON messages of the events: every tenth sent again with a higher bid, some broken.

    Some are received five hours later, some two hours before their event.
    """
    event = F.col("event_id")
    copies = F.when(event % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    sent = tracking.withColumn("copy", F.explode(copies)).withColumn(
        "bid", F.col("bid") + F.col("copy")
    )
    # A version 4 key holds no time.
    key = F.col("create_time")
    key = F.when(event % 107 == 0, F.overlay(key, F.lit("4"), F.lit(15))).otherwise(key)
    sent = sent.withColumn("create_time", key)

    def as_json(**replaced: Column) -> Column:
        fields = [replaced.get(n, F.col(n)).alias(n) for n in MESSAGE_FIELDS]
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    job_text = F.col("job_id").cast("string")
    value = (
        F.when(event % 101 == 0, F.lit("{bad"))
        .when(event % 103 == 0, as_json(bid=F.lit("abc")))
        .when(event % 7 == 0, as_json(job_id=job_text))
        .otherwise(as_json())
    )
    hours = F.when(event % 109 == 0, -2).when(event % 113 == 0, 5).otherwise(0) + F.col("copy")
    return sent.select(
        "event_id",
        "copy",
        value.alias("value"),
        (F.col("event_ts") + F.make_dt_interval(hours=hours)).alias("received_at"),
        (event * 2 + F.col("copy")).alias("offset"),
        (event % 4).cast("int").alias("partition"),
    )


def job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job ids start at 1, so job 0 is unknown; one job in seven has no group."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        (key + 1).cast("int").alias("id"),
        F.col("c_nationkey").cast("int").alias("company_id"),
        F.when(key % 7 != 4, (key + F.col("c_nationkey")) % 2).cast("int").alias("group_id"),
        (key % 3).cast("int").alias("campaign_id"),
    )


def company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("int").alias("id"), F.col("n_name").alias("name")
    )


def campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("id"),
        F.col("p_name").alias("campaign_name"),
        F.col("p_retailprice").alias("budget_total"),
    )


def publisher(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("id"), F.col("s_name").alias("publisher_name")
    )


def job_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("int").alias("id"), F.col("r_name").alias("name")
    )
