"""The registered queries: every operation on the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from jobmetrics import schemas
from jobmetrics.functions.values import second_text, text_to_ts, weighted_choice
from jobmetrics.operators import audit, clean, enrich, metrics, numbering, reports, upsert
from jobmetrics.plans import incremental, versioned
from jobmetrics.plans.fact import FACT_COLUMNS, build_fact
from jobmetrics.session import prepare, scratch_path
from jobmetrics.sinks import topic
from jobmetrics.sinks.fact_lake import read_fact
from jobmetrics.sinks.files import names_in, remove
from jobmetrics.sinks.versions import VersionedStore
from jobmetrics.sources import csv, fixtures, tables
from jobmetrics.streaming import decode, dedup, gate, hourly, ingest, keyed

Query = Callable[[SparkSession, str], DataFrame]

# The moment of a first load, where a query needs one: some events are before it, some after.
FIRST_LOAD = "TIMESTAMP '2024-01-20 07:30:00'"
MONEY = ["bid_set", "spend_hour", "spend"]
# Rows of a file of messages that arrive together.
ROWS_PER_FILE = 100_000

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    """Register a query. Its times are given without a zone, in UTC, as the tables have them."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = function(prepare(spark), sf_dir)
        zoned = [f.name for f in df.schema if isinstance(f.dataType, TimestampType)]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})

    _QUERIES[function.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Columns to four digits, so that results of two engines can be compared.

    Sums of doubles differ in the last digits with the order of addition. The shift keeps
    that from deciding a tie: 1.00005 is rounded up wherever its last bits lie.
    """
    return df.withColumns({c: F.round(F.col(c) + 1e-9, 4) for c in columns})


def _money(df: DataFrame) -> DataFrame:
    return rounded(df, *[c for c in MONEY if c in df.columns])


def _tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.tracking(fixtures.events(spark, sf_dir))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.messages(_tracking(spark, sf_dir))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.tracking_clean(tables.tracking_scan(_tracking(spark, sf_dir)))


def _job_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.job_dimension(fixtures.job(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact(_tracking(spark, sf_dir), _job_dim(spark, sf_dir))


def _before_first_load(tracking: DataFrame) -> DataFrame:
    return tracking.filter(F.col("event_ts") <= F.expr(FIRST_LOAD))


def _stamped_fact(spark: SparkSession, sf_dir: str, tracking: DataFrame) -> DataFrame:
    """A fact whose load time stands at the newest event of each cell."""
    return build_fact(tracking, _job_dim(spark, sf_dir), F.max("ts").alias("updated_at"))


def _loaded_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of the first load."""
    return _stamped_fact(spark, sf_dir, _before_first_load(_tracking(spark, sf_dir)))


def _sent_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.messages(fixtures.tracking(fixtures.events_stream(spark, sf_dir)))


def _sent_in_waves(spark: SparkSession, sf_dir: str, waves: int = 8) -> DataFrame:
    """The messages as a stream of as many batches, cut by the time they were received."""
    rows = fixtures.events(spark, sf_dir)
    # A file can be read by no more tasks than it has row groups, so rows are dealt out before messages are made of them.
    parts = max(1, -(-rows.count() // ROWS_PER_FILE))
    sent = fixtures.messages(fixtures.tracking(rows.repartition(parts, *rows.columns))).drop("event_id", "copy")
    micros = F.unix_micros("received_at")
    first, last = sent.agg(F.min(micros), F.max(micros)).first()
    wave = F.floor((micros - first) * waves / (last - first + 1))
    staged, path = scratch_path(spark, "staged"), scratch_path(spark, "waves")
    sent.withColumn("wave", wave).write.partitionBy("wave").parquet(staged)
    found = spark.read.parquet(staged)
    most = found.groupBy("wave").count().agg(F.max("count")).first()[0] or 0
    # A wave is as many files as a batch takes, written by as many tasks; empty ones stand in where rows are few.
    files = max(1, -(-most // ROWS_PER_FILE))
    for n in range(waves):
        found.filter(F.col("wave") == n).drop("wave").repartition(files).write.mode("append").parquet(path)
        written = sum(name.endswith(".parquet") for name in names_in(spark, path))
        for _ in range((n + 1) * files - written):
            spark.createDataFrame([], sent.schema).coalesce(1).write.mode("append").parquet(path)
    remove(spark, staged)
    return spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", files).parquet(path)


def _accepted_in_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.accepted(decode.decode_messages(_sent_in_waves(spark, sf_dir)))


# Scans and dimension pulls


@_query
def tracking_scan(spark, sf_dir):
    return tables.tracking_scan(_tracking(spark, sf_dir))


@_query
def latest_event_time(spark, sf_dir):
    return tables.latest_event_time(_tracking(spark, sf_dir))


@_query
def job_dim(spark, sf_dir):
    return _job_dim(spark, sf_dir)


@_query
def publisher_ids(spark, sf_dir):
    return tables.publisher_ids(fixtures.publisher(spark, sf_dir))


@_query
def group_ids(spark, sf_dir):
    return tables.group_ids(fixtures.job(spark, sf_dir))


@_query
def csv_load(spark, sf_dir):
    path = scratch_path(spark, "csv")
    _tracking(spark, sf_dir).select(*schemas.MESSAGE_FIELDS).write.option("header", True).csv(path)
    return csv.csv_load(spark, path)


@_query
def tracking_summary(spark, sf_dir):
    return clean.tracking_summary(_tracking(spark, sf_dir))


# Keys, times and draws


@_query
def encoded_events(spark, sf_dir):
    return _tracking(spark, sf_dir).select("event_id", "create_time")


@_query
def decoded_events(spark, sf_dir):
    scan = tables.tracking_scan(_tracking(spark, sf_dir))
    return clean.decode_events(scan).select("create_time", "ts")


@_query
def event_text_time(spark, sf_dir):
    decoded = clean.decode_events(_tracking(spark, sf_dir).drop("ts"))
    text = second_text(F.col("ts"))
    return decoded.select(
        "create_time", text.alias("ts_text"), text_to_ts(text).alias("ts_second")
    )


@_query
def weighted_types(spark, sf_dir):
    """Event types in the shares 70, 10, 10, 10."""
    draw = (F.col("event_id") * 37 + 11) % 100
    choice = weighted_choice(draw, clean.EVENT_TYPES, [70, 10, 10, 10])
    return fixtures.events(spark, sf_dir).select("event_id", choice.alias("custom_track"))


@_query
def assigned_publisher(spark, sf_dir):
    """A publisher for each event, and a bid of 0 or 1."""
    publishers = tables.publisher_ids(fixtures.publisher(spark, sf_dir))
    event = F.col("event_id")
    bid = (event % 2).cast("double").alias("bid")
    rows = fixtures.events(spark, sf_dir).select("event_id", bid)
    return numbering.assign_by_draw(rows, event, publishers, "publisher_id")


# Cleaning and hourly metrics


@_query
def tracking_clean(spark, sf_dir):
    return _clean(spark, sf_dir)


@_query
def events_by_type(spark, sf_dir):
    known = clean.of_known_type(_tracking(spark, sf_dir))
    return known.groupBy("custom_track").agg(F.count("*").alias("events"))


@_query
def hourly_clicks(spark, sf_dir):
    return _money(metrics.hourly_clicks(_clean(spark, sf_dir)))


@_query
def hourly_conversions(spark, sf_dir):
    return metrics.hourly_count(_clean(spark, sf_dir), "conversion", "conversions")


@_query
def hourly_qualified(spark, sf_dir):
    return metrics.hourly_count(_clean(spark, sf_dir), "qualified", "qualified")


@_query
def hourly_unqualified(spark, sf_dir):
    return metrics.hourly_count(_clean(spark, sf_dir), "unqualified", "unqualified")


@_query
def hourly_metrics(spark, sf_dir):
    return _money(metrics.hourly_metrics(_clean(spark, sf_dir)))


@_query
def hourly_metrics_joined(spark, sf_dir):
    return _money(metrics.hourly_metrics_joined(_clean(spark, sf_dir)))


# The fact and its loads


@_query
def fact(spark, sf_dir):
    return _money(_fact(spark, sf_dir))


@_query
def fact_with_surrogate(spark, sf_dir):
    numbered = numbering.with_surrogate(_fact(spark, sf_dir))
    return _money(numbered.select("id", *FACT_COLUMNS))


@_query
def incremental_load(spark, sf_dir):
    """A first load up to a moment, then a load of the rest on top of it."""
    store = incremental.FactStore(scratch_path(spark, "fact"))
    tracking, dim = _tracking(spark, sf_dir), _job_dim(spark, sf_dir)
    incremental.incremental_load(_before_first_load(tracking), dim, store)
    incremental.incremental_load(tracking, dim, store, look_back=timedelta(days=1))
    stored = read_fact(spark, store.facts)
    return _money(stored.select("id", *FACT_COLUMNS))


@_query
def incremental_rows(spark, sf_dir):
    decoded = clean.decode_events(_tracking(spark, sf_dir).drop("ts"))
    return incremental.rows_after(decoded, F.expr(FIRST_LOAD)).select("create_time", "ts")


@_query
def fact_watermark(spark, sf_dir):
    return incremental.fact_watermark(_stamped_fact(spark, sf_dir, _tracking(spark, sf_dir)))


@_query
def gate_load_time(spark, sf_dir):
    newest = tables.latest_event_time(_tracking(spark, sf_dir))
    return incremental.gate(newest, incremental.fact_watermark(_loaded_fact(spark, sf_dir)))


@_query
def gate_event_time(spark, sf_dir):
    tracking = _tracking(spark, sf_dir)
    loaded = tables.latest_event_time(_before_first_load(tracking))
    return incremental.gate(tables.latest_event_time(tracking), loaded)


# Reports


@_query
def fact_latest(spark, sf_dir):
    return _money(reports.latest_hours(_fact(spark, sf_dir)))


@_query
def daily_by_job(spark, sf_dir):
    return _money(reports.daily(_fact(spark, sf_dir), "job_id"))


@_query
def daily_by_campaign(spark, sf_dir):
    return _money(reports.daily(_fact(spark, sf_dir), "campaign_id"))


@_query
def daily_by_publisher(spark, sf_dir):
    return _money(reports.daily(_fact(spark, sf_dir), "publisher_id"))


def _funnel(fact: DataFrame, key: str) -> DataFrame:
    rates = ["conversion_rate", "qualified_share", "spend_per_conversion"]
    return rounded(reports.funnel(fact, key), *rates)


@_query
def funnel_by_job(spark, sf_dir):
    return _funnel(_fact(spark, sf_dir), "job_id")


@_query
def funnel_by_publisher(spark, sf_dir):
    return _funnel(_fact(spark, sf_dir), "publisher_id")


@_query
def fact_by_company(spark, sf_dir):
    dim = fixtures.company(spark, sf_dir)
    return _money(reports.by_dimension(_fact(spark, sf_dir), dim, "company_id", "name"))


@_query
def fact_by_publisher(spark, sf_dir):
    dim = fixtures.publisher(spark, sf_dir)
    by = reports.by_dimension(_fact(spark, sf_dir), dim, "publisher_id", "publisher_name")
    return _money(by)


@_query
def fact_by_group(spark, sf_dir):
    dim = fixtures.job_group(spark, sf_dir)
    return _money(reports.by_dimension(_fact(spark, sf_dir), dim, "group_id", "name"))


@_query
def campaign_spend_vs_budget(spark, sf_dir):
    out = reports.spend_vs_budget(_fact(spark, sf_dir), fixtures.campaign(spark, sf_dir))
    return rounded(out, "spend", "budget_left", "budget_share")


# Audits


@_query
def id_mismatch_audit(spark, sf_dir):
    return enrich.id_mismatch(_clean(spark, sf_dir), _job_dim(spark, sf_dir))


@_query
def unrecognized_events(spark, sf_dir):
    return audit.unrecognized_events(_clean(spark, sf_dir))


@_query
def rejected_ids(spark, sf_dir):
    return audit.rejected_ids(_clean(spark, sf_dir))


@_query
def bad_uuid_audit(spark, sf_dir):
    return audit.key_audit(decode.decode_messages(_messages(spark, sf_dir)))


# Messages, upsert and streams


@_query
def events_to_json(spark, sf_dir):
    """Events written as messages and read back."""
    sent = topic.events_to_json(_tracking(spark, sf_dir)).withColumns(
        {"received_at": F.current_timestamp(), "offset": F.lit(0).cast("long"),
         "partition": F.lit(0)}
    )
    return decode.accepted(decode.decode_messages(sent)).select(*schemas.MESSAGE_FIELDS)


@_query
def json_decode(spark, sf_dir):
    decoded = decode.accepted(decode.decode_messages(_messages(spark, sf_dir)))
    return decoded.select("offset", *schemas.MESSAGE_FIELDS)


@_query
def dead_letter(spark, sf_dir):
    decoded = decode.decode_messages(_messages(spark, sf_dir))
    return decode.rejected(decoded).select("offset", "reject_reason")


@_query
def tracking_upsert(spark, sf_dir):
    """First copies as the table, copies sent again as the change."""
    sent = _messages(spark, sf_dir)
    copies = [
        decode.accepted(decode.decode_messages(sent.filter(F.col("copy") == n))) for n in (0, 1)
    ]
    return upsert.upsert(*copies).select(*schemas.MESSAGE_FIELDS)


@_query
def stream_ingest(spark, sf_dir):
    path = scratch_path(spark, "ingest")
    ingest.start_ingest(_sent_stream(spark, sf_dir), path).awaitTermination()
    ingest.compact(spark, path)
    return ingest.read_tracking(spark, path)


@_query
def late_rows(spark, sf_dir):
    """Messages long after, or before, their event; what comes of a key later replaces nothing here."""
    path = scratch_path(spark, "ingest")
    ingest.start_ingest(_sent_stream(spark, sf_dir), path).awaitTermination()
    return audit.late_rows(ingest.read_versions(spark, path))


@_query
def fact_from_messages(spark, sf_dir):
    """From messages to the fact: ingest, last write per key, load of the batches that came."""
    lake, store = scratch_path(spark, "ingest"), incremental.FactStore(scratch_path(spark, "fact"))
    ingest.start_ingest(_sent_stream(spark, sf_dir), lake).awaitTermination()
    incremental.load_from_lake(spark, lake, _job_dim(spark, sf_dir), store)
    return _money(read_fact(spark, store.facts).select(*FACT_COLUMNS))


@_query
def stream_dedup(spark, sf_dir):
    """The columns in which all copies agree; which copy comes first is up to the stream."""
    path = scratch_path(spark, "dedup")
    good = decode.accepted(decode.decode_messages(_sent_stream(spark, sf_dir)))
    same = "create_time STRING, custom_track STRING, job_id DOUBLE, publisher_id DOUBLE, "
    layout = f"{same} campaign_id DOUBLE, group_id DOUBLE, dates DATE"
    dedup.start_first_copies(good, path, layout).awaitTermination()
    return dedup.read_first_copies(spark, path, layout).drop("dates")


@_query
def stream_hourly_metrics(spark, sf_dir):
    """From messages, with those sent again: the last write counts."""
    lake, path = scratch_path(spark, "ingest"), scratch_path(spark, "hourly")
    hourly.start_hourly(_sent_stream(spark, sf_dir), lake, path).awaitTermination()
    return _money(hourly.read_hourly(spark, path))


@_query
def stream_hourly_changes(spark, sf_dir):
    """From messages in eight batches, each adding what it changes: the last write counts."""
    path = scratch_path(spark, "changes")
    keyed.start_hourly_changes(_accepted_in_waves(spark, sf_dir), path, compact_every=3).awaitTermination()
    return _money(keyed.read_hourly_changes(spark, path))


@_query
def stream_first_copies(spark, sf_dir):
    """Whole first copies over eight batches, from keyed state."""
    path, layout = scratch_path(spark, "first"), f"{schemas.MESSAGE}, dates DATE"
    keyed.start_first_copies(_accepted_in_waves(spark, sf_dir), path, layout).awaitTermination()
    return keyed.read_first_copies(spark, path, layout).drop("dates")


def _through_gate(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "gate")
    gate.start_gate(_accepted_in_waves(spark, sf_dir), path, delay="1 hour").awaitTermination()
    return path


@_query
def stream_closed_hours(spark, sf_dir):
    """Cells of the events that came before their hour was closed, with the state of closed hours given up."""
    passed, path = _through_gate(spark, sf_dir), scratch_path(spark, "changes")
    events = gate.open_events(spark, passed, maxFilesPerTrigger="100")
    keyed.start_hourly_changes(events, path).awaitTermination()
    return _money(keyed.read_hourly_changes(spark, path))


@_query
def stream_late_events(spark, sf_dir):
    """What came after its hour was closed, with the clock that closed it."""
    late = gate.late_events(spark, _through_gate(spark, sf_dir))
    return late.select("offset", "create_time", "clock", "reason")


# Versioned loads


@_query
def versioned_load(spark, sf_dir):
    """Loads of an event lake between its batches, each swapping in the days that differ."""
    lake, store = scratch_path(spark, "ingest"), VersionedStore(scratch_path(spark, "versions"))
    sent, dim = _sent_in_waves(spark, sf_dir, waves=4), _job_dim(spark, sf_dir)
    # Each batch is loaded as soon as it is stored.
    ingest.start_ingest(sent, lake, then=lambda session, batch: versioned.load_from_lake(
        session, lake, dim, store)).awaitTermination()
    return _money(versioned.read_fact(spark, store).select(*FACT_COLUMNS))


def _loaded_from_files(spark: SparkSession, sf_dir: str) -> VersionedStore:
    """Events arriving as files, in no order of time, loaded as they come."""
    path, store = scratch_path(spark, "events"), VersionedStore(scratch_path(spark, "versions"))
    source = tables.Table("parquet", {"path": path})
    for n in range(3):
        wave = F.pmod(F.xxhash64("event_id"), F.lit(3)) == n
        _tracking(spark, sf_dir).filter(wave).write.mode("append").parquet(path)
        versioned.load_from_files(spark, source, _job_dim(spark, sf_dir), store)
    return store


@_query
def file_ledger_load(spark, sf_dir):
    return _money(versioned.read_fact(spark, _loaded_from_files(spark, sf_dir)).select(*FACT_COLUMNS))


@_query
def daily_rollup(spark, sf_dir):
    """Daily totals per job from the totals of days stored with each load."""
    return _money(versioned.read_daily(spark, _loaded_from_files(spark, sf_dir), "job_id"))
