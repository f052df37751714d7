"""Loading the fact: in full, or only the days new events touch.

A load of new events cannot add to existing cells, since a replay would count twice. It
recomputes whole days and replaces them, also those that are left without rows. Which days:

* ``load_from_lake`` goes by arrival, for a lake written by the ingest stream: the days named
  in batches that came after the last load. It misses neither late events nor changed ones.
* ``incremental_load`` is for event tables that do not say what arrived when. When there is
  an event later than the watermark, all days are recomputed. A look-back limits that to the
  days since the watermark less so much time; ``audit.stale_days`` tells what it leaves out.

Each load is recorded beside the fact, after the fact is written, so a load that dies
half-way is repeated in full by the next one.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from jobmetrics import schemas
from jobmetrics.functions.time_uuid import uuid_to_ts
from jobmetrics.operators.clean import of_known_type, tracking_clean
from jobmetrics.operators.numbering import with_surrogate
from jobmetrics.plans.fact import SOURCE_NAME, build_fact
from jobmetrics.sinks.fact_lake import replace_days, replace_fact
from jobmetrics.sources.tables import read_if_present
from jobmetrics.streaming import ingest
from jobmetrics.streaming.batch_log import last_batch

# Fixed value: the watermark of an empty fact, 1998-01-01 00:00:00 UTC. Watermarks are kept
# as microseconds since 1970, which mean the same whatever the driver's time zone.
NEVER_LOADED = 883612800000000

_LOADS = "loaded_through TIMESTAMP, loaded_batch BIGINT, loaded_at TIMESTAMP, days ARRAY<DATE>"


@dataclass(frozen=True)
class FactStore:
    """Paths of the fact and of the record of its loads."""

    path: str

    @property
    def facts(self) -> str:
        return f"{self.path}/facts"

    @property
    def loads(self) -> str:
        return f"{self.path}/loads"


def as_ts(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros))


def fact_watermark(fact: DataFrame) -> DataFrame:
    """One row: the newest load time in the fact, cut to the second."""
    newest = F.coalesce(F.max("updated_at"), as_ts(NEVER_LOADED))
    return fact.agg(F.date_trunc("second", newest).alias("max_ts"))


def gate(newest: DataFrame, watermark: DataFrame) -> DataFrame:
    """One row: both times, and whether there is anything strictly newer to load.

    Both inputs have one row with ``max_ts``. Without events the answer is false.
    """
    both = newest.select(
        F.col("max_ts").alias("newest_event_ts"), watermark.scalar().alias("watermark")
    )
    is_newer = F.coalesce(F.col("newest_event_ts") > F.col("watermark"), F.lit(False))
    return both.withColumn("has_new", is_newer)


def rows_after(events: DataFrame, watermark: Column) -> DataFrame:
    """Decoded events strictly later than the watermark."""
    return events.filter(F.col("ts") > watermark)


def events_since_day(tracking: DataFrame, micros: int) -> DataFrame:
    """Events of the day that holds the given time, and of later days.

    A lake partitioned by ``dates`` is pruned to these days; other sources are filtered on
    the time in the key.
    """
    day = F.to_date(as_ts(micros))
    if "dates" in tracking.columns:
        return tracking.filter(F.col("dates") >= day)
    return tracking.filter(uuid_to_ts(F.col("create_time")) >= day.cast("timestamp"))


def _last_load(spark: SparkSession, store: FactStore, mark: Column) -> int | None:
    loads = read_if_present(spark, store.loads, _LOADS)
    return None if loads is None else loads.agg(F.max(mark)).first()[0]


def loaded_through(spark: SparkSession, store: FactStore) -> int | None:
    """Newest event time already loaded, None before the first load."""
    return _last_load(spark, store, F.unix_micros("loaded_through"))


def loaded_batch(spark: SparkSession, store: FactStore) -> int | None:
    """Last batch of the lake already loaded, None before the first load."""
    return _last_load(spark, store, F.col("loaded_batch"))


def days_of_last_load(spark: SparkSession, store: FactStore) -> list[date] | None:
    """Days that the last load replaced, None if it replaced all."""
    loads = read_if_present(spark, store.loads, _LOADS)
    return None if loads is None else loads.agg(F.max_by("days", "loaded_at")).first()[0]


def newest_countable(tracking: DataFrame) -> DataFrame:
    """One row: the time of the newest event that counts for the fact (``max_ts``)."""
    return of_known_type(tracking_clean(tracking)).agg(F.max("ts").alias("max_ts"))


def _record(
    spark: SparkSession, store: FactStore, newest: int | None, batch: int | None = None,
    days: list[date] | None = None,
) -> None:
    # An event dated in the future must not hold up the events until then.
    through = F.least(as_ts(newest), F.current_timestamp()) if newest is not None else F.lit(None)
    row = spark.range(1).select(
        through.cast("timestamp").alias("loaded_through"),
        F.lit(batch).cast("long").alias("loaded_batch"),
        F.current_timestamp().alias("loaded_at"),
        (F.lit(None) if days is None else F.array(*[F.lit(d) for d in days])).cast("array<date>").alias("days"),
    )
    row.coalesce(1).write.mode("append").parquet(store.loads)


def _numbered(
    tracking: DataFrame, job_dim: DataFrame, source_name: str
) -> tuple[DataFrame, Observation]:
    """Fact rows, and what their write will have seen as newest event: no scan of its own."""
    fact = build_fact(tracking, job_dim, F.max("ts").alias("newest"), source_name=source_name)
    seen = Observation()
    rows = fact.observe(seen, F.unix_micros(F.max("newest")).alias("newest")).drop("newest")
    return with_surrogate(rows), seen


def newest_of(seen: Observation) -> int | None:
    """What a write has observed; None if its rows were found to be none before it ran."""
    try:
        return seen.get["newest"]
    except Py4JJavaError:
        return None


def full_refresh(
    tracking: DataFrame, job_dim: DataFrame, store: FactStore, source_name: str = SOURCE_NAME
) -> bool:
    """Recompute the fact from all events, in one scan, and replace it; False if it is empty."""
    rows, seen = _numbered(tracking, job_dim, source_name)
    replace_fact(rows, store.facts)
    newest = newest_of(seen)
    if newest is not None:
        _record(tracking.sparkSession, store, newest)
    return newest is not None


def incremental_load(
    tracking: DataFrame,
    job_dim: DataFrame,
    store: FactStore,
    look_back: timedelta | None = None,
    source_name: str = SOURCE_NAME,
) -> bool:
    """Load when there is an event later than the watermark; False when there is none.

    ``look_back`` recomputes only the watermark's day, that much before it, and all after it.
    """
    spark = tracking.sparkSession
    watermark = loaded_through(spark, store)
    if watermark is None:
        return full_refresh(tracking, job_dim, store, source_name)
    # Nothing before the watermark's day can be newer, so only these days are searched.
    recent = events_since_day(tracking, watermark)
    loaded = spark.range(1).select(as_ts(watermark).alias("max_ts"))
    if not gate(newest_countable(recent), loaded).first()["has_new"]:
        return False
    if look_back is None:
        return full_refresh(tracking, job_dim, store, source_name)
    since = watermark - look_back // timedelta(microseconds=1)
    rows, seen = _numbered(events_since_day(tracking, since), job_dim, source_name)
    before = set(_days_since(spark, store, since))
    replace_days(rows, store.facts, before)
    _record(spark, store, newest_of(seen), days=sorted(before.union(_days_since(spark, store, since))))
    return True


def _days_since(spark: SparkSession, store: FactStore, micros: int) -> list[date]:
    """Days of the fact that a load from this time on replaces."""
    stored = read_if_present(spark, store.facts, schemas.FACT)
    if stored is None:
        return []
    days = stored.filter(F.col("dates") >= F.to_date(as_ts(micros))).select("dates").distinct()
    return [row["dates"] for row in days.collect()]


def load_from_lake(
    spark: SparkSession,
    lake: str,
    job_dim: DataFrame,
    store: FactStore,
    full: bool = False,
    source_name: str = SOURCE_NAME,
) -> bool:
    """Load the batches of an event lake that came since the last load; False without any."""
    newest = last_batch(spark, lake)
    loaded = None if full else loaded_batch(spark, store)
    if newest is None or (loaded is not None and newest <= loaded):
        return False
    tracking, days = ingest.read_tracking(spark, lake, newest), None
    if loaded is None:
        rows, seen = _numbered(tracking, job_dim, source_name)
        replace_fact(rows, store.facts)
    else:
        days = ingest.touched_days(spark, lake, newest, loaded)
        rows, seen = _numbered(tracking.filter(F.col("dates").isin(days)), job_dim, source_name)
        replace_days(rows, store.facts, days)
    _record(spark, store, newest_of(seen), newest, days)
    return True
