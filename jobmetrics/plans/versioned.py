"""Loads of a versioned fact: what they change is swapped in at once, and only what differs counts as changed.

A load computes the touched days anew, as ``plans.incremental`` does, and compares them with what is stored. A cell whose
values are the same keeps its row whole, with id and ``updated_at``; one whose values differ keeps its id; a new
cell gets the next free id of its hour. Days without any difference keep their version, so they are neither
published again nor rolled up again. Daily totals of the days that did change are written with the same version.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from jobmetrics import schemas
from jobmetrics.functions.time_uuid import uuid_to_ts
from jobmetrics.operators.numbering import BUCKETS, IDS_PER_HOUR, hash_bucket
from jobmetrics.operators.reports import COUNTS, daily
from jobmetrics.plans.fact import FACT_COLUMNS, SOURCE_NAME, build_fact
from jobmetrics.sinks import versions
from jobmetrics.sinks.versions import VersionedStore
from jobmetrics.sources import file_ledger
from jobmetrics.sources.tables import TRACKING_COLUMNS, Table
from jobmetrics.streaming import ingest
from jobmetrics.streaming.batch_log import last_batch

FACTS, DAILY = "facts", "daily"
CELL = ["dates", "hours", "job_id", "publisher_id", "campaign_id", "group_id"]
_IDS = ["job_id", "publisher_id", "campaign_id", "group_id"]
_VALUES = [c for c in FACT_COLUMNS if c not in CELL]
_AMOUNTS = ["bid_set", "spend_hour"]
# Sums of doubles differ in the last digits with the order of addition.
_CLOSE = 1e-9
DAILY_LAYOUT = ("job_id BIGINT, publisher_id BIGINT, company_id BIGINT, campaign_id BIGINT, group_id BIGINT, clicks BIGINT, "
                "conversion BIGINT, qualified_application BIGINT, disqualified_application BIGINT, spend_hour DOUBLE, dates DATE")
_DAILY_KEYS = ["dates", "job_id", "publisher_id", "company_id", "campaign_id", "group_id"]


def _same(name: str) -> Column:
    new, old = F.col(f"n.{name}"), F.col(f"o.{name}")
    if name not in _AMOUNTS:
        return new.eqNullSafe(old)
    near = F.abs(new - old) <= _CLOSE * F.greatest(F.abs(new), F.abs(old))
    return F.coalesce(near, F.lit(False)) | new.eqNullSafe(old)


def merged(fresh: DataFrame, stored: DataFrame, now: Column) -> DataFrame:
    """``fresh`` cells with id and ``updated_at``, and whether each ``differs`` from the stored one."""
    same = F.col("o.id").isNotNull()
    for name in _VALUES:
        same = same & _same(name)
    on = [F.col(f"n.{c}") == F.col(f"o.{c}") for c in CELL]
    both = fresh.select(*FACT_COLUMNS).alias("n").join(stored.alias("o"), on, "left").select(
        *[F.col(f"n.{c}").alias(c) for c in CELL],
        *[F.when(same, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in _VALUES],
        F.col("o.id").alias("old_id"), F.when(same, F.col("o.updated_at")).otherwise(now).alias("updated_at"),
        (~same).alias("differs"))
    # Ids of an hour are dealt in buckets, see numbering.with_surrogate; new ones follow those in use.
    number = F.pmod(F.col("id") - 1, F.lit(IDS_PER_HOUR))
    used = stored.groupBy("dates", "hours", F.pmod(number, F.lit(BUCKETS)).alias("bucket")).agg(
        (F.max(F.floor(number / BUCKETS)) + 1).alias("first"))
    bucketed = both.withColumn("bucket", hash_bucket(_IDS)).join(used, ["dates", "hours", "bucket"], "left")
    is_new = F.col("old_id").isNull()
    within = Window.partitionBy("dates", "hours", "bucket", is_new).orderBy(*_IDS)
    place = (F.coalesce("first", F.lit(0)) + F.row_number().over(within) - 1) * BUCKETS + F.col("bucket") + 1
    full = F.raise_error(F.lit(f"an hour has room for {IDS_PER_HOUR} ids only")).cast("long")
    hour = F.unix_date("dates").cast("long") * 24 + F.col("hours")
    drawn = hour * IDS_PER_HOUR + F.when(place <= IDS_PER_HOUR, place).otherwise(full)
    return bucketed.withColumn("id", F.coalesce("old_id", drawn).cast("long")).select(
        *schemas.column_names(schemas.FACT), "differs")


def totals_by_day(facts: DataFrame) -> DataFrame:
    """Hours summed up to days, in a form that can be summed further: counts and spend, NULL without events."""
    return facts.groupBy(*_DAILY_KEYS).agg(*[F.sum(c).alias(c) for c in [*COUNTS, "spend_hour"]])


def replace(spark: SparkSession, store: VersionedStore, fresh: DataFrame, days: Collection[date] | None,
            batch: int | None = None) -> list[date]:
    """Let ``fresh`` be the fact of ``days``, or of all days; returns the days that differ from before.

    The load counts, and is known by its ``batch``, even if no day differs.
    """
    version = versions.following(spark, store)
    now = spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
    before = versions.read(spark, store, FACTS, schemas.FACT, days)
    versions.stage(merged(fresh, before, F.timestamp_micros(F.lit(now))), store, FACTS, version)
    layout = f"{schemas.FACT}, differs BOOLEAN"
    staged = spark.read.schema(layout).parquet(store.folder(FACTS, version))
    found = staged.groupBy("dates").agg(F.count("*").alias("rows"), F.count_if("differs").alias("differ"))
    had = versions.index(spark, store).filter("rows > 0")
    if days is not None:
        had = had.filter(F.col("dates").isin(list(days)))
    both = found.join(had.select("dates", F.col("rows").alias("had")), "dates", "full").na.fill(0, ["rows", "differ", "had"])
    changed = both.filter((F.col("differ") > 0) | (F.col("rows") != F.col("had"))).select("dates", "rows")
    # One row per day at most.
    found = changed.collect()
    changed, listed = spark.createDataFrame(found, "dates DATE, rows BIGINT"), [r["dates"] for r in found]
    versions.stage(totals_by_day(staged.filter(F.col("dates").isin(listed))), store, DAILY, version)
    versions.commit(spark, store, version, changed, batch)
    return sorted(listed)


def load_from_lake(spark: SparkSession, lake: str, job_dim: DataFrame, store: VersionedStore, full: bool = False,
                   source_name: str = SOURCE_NAME) -> list[date] | None:
    """Load the batches of an event lake that came since the last load: the days that differ, None without any batch."""
    newest, last = last_batch(spark, lake), versions.last_load(spark, store)
    loaded = None if full or last is None else last["loaded_batch"]
    if newest is None or (loaded is not None and newest <= loaded):
        return None
    tracking, days = ingest.read_tracking(spark, lake, newest), None
    if loaded is not None:
        days = ingest.touched_days(spark, lake, newest, loaded)
        tracking = tracking.filter(F.col("dates").isin(days))
    return replace(spark, store, build_fact(tracking, job_dim, source_name=source_name), days, newest)


def _ledger(spark: SparkSession, store: VersionedStore) -> DataFrame:
    version = versions.current(spark, store)
    if version is None:
        return spark.createDataFrame([], file_ledger.LEDGER)
    return spark.read.schema(file_ledger.LEDGER).parquet(store.folder("files", version))


def load_from_files(spark: SparkSession, table: Table, job_dim: DataFrame, store: VersionedStore,
                    source_name: str = SOURCE_NAME) -> list[date] | None:
    """Load what new files of an event table bring, and what gone ones took away; None if there are neither.

    Without either no event file is read. Otherwise the new ones are, for the days of their events, and then all files
    with events of these days.
    """
    events = table.load(spark)
    ledger = _ledger(spark, store)
    new, gone = file_ledger.compared(events, ledger)
    if not new and gone.isEmpty():
        return None
    version = versions.following(spark, store)
    arrived = file_ledger.read_files(spark, table, events, new)
    described = file_ledger.described(arrived) if new else spark.createDataFrame([], file_ledger.LEDGER)
    # A new file without a usable event is remembered too.
    names = spark.createDataFrame([(f,) for f in new], "file STRING")
    known = names.join(described, "file", "left").withColumn("days", F.coalesce("days", F.array().cast("array<date>")))
    kept = ledger.join(gone.select("file"), "file", "left_anti")
    kept.unionByName(known).write.mode("overwrite").parquet(store.folder("files", version))
    # Counts only with the index of its version.
    after = spark.read.schema(file_ledger.LEDGER).parquet(store.folder("files", version))
    came = after.join(names.select("file"), "file", "left_semi")
    days = came.unionByName(gone).select(F.explode("days").alias("day")).distinct()
    days = sorted(r["day"] for r in days.collect())
    rows = file_ledger.read_files(spark, table, events, file_ledger.files_with(after, days)).select(*TRACKING_COLUMNS)
    touched = rows.filter(F.to_date(uuid_to_ts(F.col("create_time"))).isin(days))
    return replace(spark, store, build_fact(touched, job_dim, source_name=source_name), days)


def read_fact(spark: SparkSession, store: VersionedStore, days: Collection[date] | None = None) -> DataFrame:
    return versions.read(spark, store, FACTS, schemas.FACT, days)


def read_daily(spark: SparkSession, store: VersionedStore, key: str) -> DataFrame:
    """``reports.daily`` from the stored totals of days."""
    return daily(versions.read(spark, store, DAILY, DAILY_LAYOUT), key)
