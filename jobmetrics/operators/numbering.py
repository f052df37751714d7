"""Reproducible numbers for rows, without a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Fixed values of the surrogate key: rows per hour it has room for, and hash buckets per hour.
# Any hour a version 1 UUID can name (1582 to 5236) times the first stays within a BIGINT.
IDS_PER_HOUR = 10**11
BUCKETS = 256


def hash_bucket(keys: Sequence[str]) -> Column:
    """0..255 from the first byte of the key's MD5, so that equal hours spread evenly."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 2), 16, 10).cast("long")


def with_surrogate(fact: DataFrame) -> DataFrame:
    """Add ``id``: unique, the same on every run, and unaffected by other hours.

    The id is the hour since 1970 and a number within it. Numbers are drawn in 256 buckets
    per hour, so an hour that holds most of the fact is numbered by 256 tasks; like an
    auto-increment column, ids may have gaps.
    """
    cell = ["job_id", "publisher_id", "campaign_id", "group_id"]
    bucketed = fact.withColumn("_bucket", hash_bucket(cell))
    within = Window.partitionBy("dates", "hours", "_bucket").orderBy(*cell)
    number = (F.row_number().over(within) - 1) * BUCKETS + F.col("_bucket") + 1
    full = F.raise_error(F.lit(f"an hour has room for {IDS_PER_HOUR} ids only")).cast("long")
    number = F.when(number <= IDS_PER_HOUR, number).otherwise(full)
    hour = F.unix_date("dates").cast("long") * 24 + F.col("hours")
    return bucketed.withColumn("id", hour * IDS_PER_HOUR + number).drop("_bucket")


def dense_index(table: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Number the rows of ``table`` from 0 by (hash bucket, key); also the one-row total.

    Only the counts of the 256 buckets meet in one window; the rows themselves are numbered
    bucket by bucket. The starts travel as one map of at most 256 entries.
    """
    bucketed = table.withColumn("_bucket", hash_bucket([key]))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_size").over(before), F.lit(0))
    starts = sizes.select(F.struct("_bucket", start.alias("_start")).alias("entry")).agg(
        F.map_from_entries(F.collect_list("entry")).alias("starts")
    )
    within = Window.partitionBy("_bucket").orderBy(key)
    numbered = bucketed.withColumn("_rank", F.row_number().over(within)).select(
        *table.columns,
        (F.try_element_at(starts.scalar(), F.col("_bucket")) + F.col("_rank") - 1).alias("index"),
    )
    total = sizes.agg(F.sum("_size").alias("total"))
    return numbered, total


def assign_by_draw(rows: DataFrame, draw: Column, choices: DataFrame, key: str) -> DataFrame:
    """Give each row one of the choices, the ``draw``-th modulo their number.

    Without choices the column is NULL.
    """
    numbered, total = dense_index(choices.select(key), key)
    picked = rows.withColumn("index", F.pmod(draw, total.scalar()))
    return picked.join(numbered, "index", "left").drop("index")
