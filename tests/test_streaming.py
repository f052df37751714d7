import json
from datetime import datetime, timedelta

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from jobmetrics.operators import audit
from jobmetrics.operators.clean import tracking_clean
from jobmetrics.operators.metrics import hourly_metrics
from jobmetrics.operators.upsert import latest_by_key
from jobmetrics.plans import incremental
from jobmetrics.plans.fact import FACT_COLUMNS, build_fact
from jobmetrics.schemas import MESSAGE_FIELDS
from jobmetrics.sinks.fact_lake import read_fact
from jobmetrics.sources import fixtures
from jobmetrics.streaming import batch_log, dedup, hourly, ingest
from jobmetrics.streaming.batch_log import compacted_upto, last_batch
from jobmetrics.streaming.decode import accepted, decode_messages, rejected

MESSAGE = "value string, received_at timestamp, offset long, partition int"
START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def messages(tracking):
    return fixtures.messages(tracking).select("value", "received_at", "offset", "partition")


def stream_of(spark, path, schema, **options):
    return spark.readStream.schema(schema).options(**options).parquet(path)


def decoded(spark, *values):
    rows = [(v, START, i, 0) for i, v in enumerate(values)]
    return decode_messages(spark.createDataFrame(rows, MESSAGE))


KEY = '"create_time": "b4cc8000-a838-11ee-8000-000000000000"'


@pytest.mark.parametrize(
    "value, reason",
    [
        (f'{{{KEY}, "bid": 1.5, "job_id": "3"}}', None),
        (f'{{{KEY}, "bid": null}}', None),
        (f'{{{KEY}, "bid": true}}', None),
        (f'{{{KEY}, "bid": NaN}}', None),
        (f'{{{KEY}}}\n', None),
        (f'{{{KEY}, "bid": "abc"}}', "not_numeric"),
        (f'{{{KEY}, "job_id": ""}}', "not_numeric"),
        (f'{{{KEY}, "bid": {{"a": 1}}}}', "not_numeric"),
        (f'{{{KEY}}} more', "malformed_json"),
        ("{bad", "malformed_json"),
        ("[1, 2]", "malformed_json"),
        ("null", "malformed_json"),
        ("", "malformed_json"),
        (None, "malformed_json"),
        ('{"bid": 1}', "bad_create_time"),
        ('{"create_time": "x", "bid": 1}', "bad_create_time"),
        ('{"create_time": "13814000-1dd2-11b2-8000-000000000000"}', "implausible_time"),
        ('{"create_time": "ffffffff-ffff-1fff-8000-000000000000"}', "implausible_time"),
    ],
)
def test_message_states(spark, value, reason):
    out = decoded(spark, value)
    assert out.first()["reject_reason"] == reason
    assert (accepted(out).count(), rejected(out).count()) == ((1, 0) if reason is None else (0, 1))
    if reason:
        assert rejected(out).first()["raw"] == value


def test_broken_text_is_rejected(spark):
    df = spark.createDataFrame([(b'{"bid": "\xff\xfe"}', START, 0, 0)],
                               MESSAGE.replace("value string", "value binary"))
    assert decode_messages(df).first()["reject_reason"] == "malformed_json"


def test_json_is_parsed_once(messages):
    assert plan_of(accepted(decode_messages(messages))).count("from_json(") == 1


def _waves(messages, folder, waves=3):
    """The messages in files that come one after another, in time order."""
    total = messages.agg(F.max("offset")).first()[0] + 1
    for n in range(waves):
        part = messages.filter(F.floor(F.col("offset") * waves / total) == n)
        part.coalesce(1).write.mode("append").parquet(folder)
        yield n


def test_ingest_in_waves_equals_batch_upsert(spark, messages, tmp_path):
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    for _ in _waves(messages, source):
        stream = stream_of(spark, source, MESSAGE, maxFilesPerTrigger=1)
        ingest.start_ingest(stream, lake).awaitTermination()
    good = accepted(decode_messages(messages))
    want = latest_by_key(good).select(*MESSAGE_FIELDS)
    got = ingest.read_tracking(spark, lake)
    assert rows_of(got.select(*MESSAGE_FIELDS)) == rows_of(want)
    bad = rejected(decode_messages(messages)).select("offset", "reject_reason", "raw")
    letters = ingest.read_dead_letters(spark, lake).select("offset", "reject_reason", "raw")
    assert rows_of(letters) == rows_of(bad)
    # Starting again without new messages adds nothing.
    before = ingest.read_versions(spark, lake).count()
    again = stream_of(spark, source, MESSAGE)
    ingest.start_ingest(again, lake).awaitTermination()
    assert ingest.read_versions(spark, lake).count() == before


def test_replayed_batch_replaces_itself(spark, messages, tmp_path):
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    messages.coalesce(1).write.parquet(source)
    ingest.start_ingest(stream_of(spark, source, MESSAGE), lake).awaitTermination()
    before = ingest.read_versions(spark, lake).count()
    # The commit of the batch is lost, as when the driver dies right after writing.
    for name in ("0", ".0.crc"):
        commit = tmp_path / "lake" / "checkpoint" / "commits" / name
        if commit.exists():
            commit.unlink()
    ingest.start_ingest(stream_of(spark, source, MESSAGE), lake).awaitTermination()
    assert ingest.read_versions(spark, lake).count() == before


def test_days_are_pruned_below_the_choice_of_versions(spark, messages, tmp_path):
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    messages.coalesce(1).write.parquet(source)
    ingest.start_ingest(stream_of(spark, source, MESSAGE), lake).awaitTermination()
    some = ingest.read_tracking(spark, lake, 0).filter("dates >= date'2024-01-25'")
    pruned = plan_of(some).split("PartitionFilters: [")[1].split("]")[0]
    assert "dates" in pruned and "outcome" in pruned


def _end_state(spark, lake, job_dim):
    return rows_of(build_fact(ingest.read_tracking(spark, lake), job_dim))


def _stored(spark, store):
    return rows_of(read_fact(spark, store.facts).select(*FACT_COLUMNS))


def test_fact_follows_the_lake(spark, messages, job_dim, tmp_path):
    """Waves out of time order, with late events and changed ones: each load is complete."""
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    store = incremental.FactStore(str(tmp_path / "store"))
    assert not incremental.load_from_lake(spark, lake, job_dim, store)
    again = F.col("offset") % 2 == 1
    old = F.col("received_at") < F.lit("2024-01-15").cast("timestamp")
    for wave in (~again & ~old, ~again & old, again):
        messages.filter(wave).coalesce(1).write.mode("append").parquet(source)
        ingest.start_ingest(stream_of(spark, source, MESSAGE), lake).awaitTermination()
        assert incremental.load_from_lake(spark, lake, job_dim, store)
        assert _stored(spark, store) == _end_state(spark, lake, job_dim)
        assert not incremental.load_from_lake(spark, lake, job_dim, store)
    before = _stored(spark, store)
    assert incremental.load_from_lake(spark, lake, job_dim, store, full=True)
    assert _stored(spark, store) == before


def test_load_leaves_out_the_batch_being_written(spark, messages, job_dim, tmp_path):
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    store = incremental.FactStore(str(tmp_path / "store"))
    for wave in (F.col("offset") < 1000, F.col("offset") >= 1000):
        messages.filter(wave).coalesce(1).write.mode("append").parquet(source)
        ingest.start_ingest(stream_of(spark, source, MESSAGE), lake).awaitTermination()
    whole = _end_state(spark, lake, job_dim)
    # The second batch has written some files but is not marked as done.
    (tmp_path / "lake" / "done" / "batch=1").rename(tmp_path / "mark")
    assert incremental.load_from_lake(spark, lake, job_dim, store)
    assert incremental.loaded_batch(spark, store) == 0
    assert _stored(spark, store) != whole
    (tmp_path / "mark").rename(tmp_path / "lake" / "done" / "batch=1")
    assert incremental.load_from_lake(spark, lake, job_dim, store)
    assert _stored(spark, store) == whole


def _feed(messages, folder, parts):
    """The messages in files that come one after another, in no order of time."""
    for n in range(parts):
        part = messages.filter(F.pmod(F.xxhash64("offset"), F.lit(parts)) == n)
        part.coalesce(1).write.mode("append").parquet(folder)


def test_hourly_stream_in_many_batches_equals_batch(spark, messages, tmp_path):
    """Resends, late and early rows, one file a batch: no event is lost, the last write counts."""
    source, lake, path = (str(tmp_path / n) for n in ("in", "lake", "hourly"))
    _feed(messages, source, 5)
    stream = stream_of(spark, source, MESSAGE, maxFilesPerTrigger=1)
    hourly.start_hourly(stream, lake, path, compact_every=2).awaitTermination()
    assert last_batch(spark, lake) == 4 and compacted_upto(spark, lake) == 3
    want = latest_by_key(accepted(decode_messages(messages)))
    assert rows_of(hourly.read_hourly(spark, path)) == rows_of(hourly_metrics(tracking_clean(want.drop("dates"))))


def _sent(rows):
    """Messages from (hour of the event, number, job, hours until received, offset)."""
    out = []
    for hour, number, job, wait, offset in rows:
        at = START + timedelta(hours=hour)
        steps = int((at - datetime(1582, 10, 15)).total_seconds() * 10**7)
        digits = f"{steps:015x}"
        key = f"{digits[7:]}-{digits[3:7]}-1{digits[:3]}-8000-{number:012x}"
        body = {"create_time": key, "job_id": job, "custom_track": "click", "bid": 1.0}
        out.append((json.dumps(body), at + timedelta(hours=wait), offset, 0))
    return out


def _hours(spark, path):
    cells = hourly.read_hourly(spark, path).groupBy("date", "hour").agg(F.sum("clicks").alias("n"))
    return {(r["date"].day, r["hour"]): r["n"] for r in cells.collect()}


def test_no_event_is_too_late_and_an_emptied_day_goes(spark, tmp_path):
    source, lake, path = (str(tmp_path / n) for n in ("in", "lake", "hourly"))

    def arrive(*rows):
        spark.createDataFrame(_sent(rows), MESSAGE).coalesce(1).write.mode("append").parquet(source)
        hourly.start_hourly(stream_of(spark, source, MESSAGE), lake, path).awaitTermination()
        return _hours(spark, path)

    assert arrive((0.1, 1, 5, 0, 0), (0.2, 2, 5, 0, 1), (1.5, 3, 5, 0, 2)) == {(1, 0): 2, (1, 1): 1}
    assert arrive((200.0, 4, 5, 0, 3)) == {(1, 0): 2, (1, 1): 1, (9, 8): 1}
    # A week late, and sent again without change.
    assert arrive((0.3, 5, 5, 300, 4), (0.2, 2, 5, 300, 5)) == {(1, 0): 3, (1, 1): 1, (9, 8): 1}
    # Sent again without a job: the only event of its day goes, and with it the day.
    assert arrive((200.0, 4, None, 1, 6)) == {(1, 0): 3, (1, 1): 1}
    late = audit.late_rows(ingest.read_versions(spark, lake)).collect()
    assert {(r["offset"], r["reason"]) for r in late} == {(4, "late"), (5, "late")}
    # A day ahead of the clock is no event time.
    assert arrive((24 * 365 * 200, 6, 5, -24 * 365 * 200, 7)) == {(1, 0): 3, (1, 1): 1}
    assert [r["reject_reason"] for r in ingest.read_dead_letters(spark, lake).collect()] == ["implausible_time"]


def test_a_resend_that_empties_a_day_empties_the_fact(spark, job_dim, tmp_path):
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    store = incremental.FactStore(str(tmp_path / "store"))
    for rows in ([(0.5, 1, 5, 0, 0), (30.0, 2, 5, 0, 1)], [(0.5, 1, None, 1, 2)]):
        spark.createDataFrame(_sent(rows), MESSAGE).coalesce(1).write.mode("append").parquet(source)
        ingest.start_ingest(stream_of(spark, source, MESSAGE), lake).awaitTermination()
        assert incremental.load_from_lake(spark, lake, job_dim, store)
        assert _stored(spark, store) == _end_state(spark, lake, job_dim)
    assert [r["dates"].day for r in read_fact(spark, store.facts).collect()] == [2]
    assert incremental.days_of_last_load(spark, store) == [START.date()]


def _files_read(df):
    return len(df.inputFiles())


def test_many_batches_are_read_from_few_files(spark, messages, job_dim, tmp_path):
    """Compaction bounds what is listed and read, and changes no result."""
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    _feed(messages.filter("received_at < timestamp'2024-01-04'"), source, 42)
    stream = stream_of(spark, source, MESSAGE, maxFilesPerTrigger=1)
    ingest.start_ingest(stream, lake, compact_every=10).awaitTermination()
    assert last_batch(spark, lake) == 41
    want = rows_of(latest_by_key(accepted(decode_messages(messages.filter(
        "received_at < timestamp'2024-01-04'")))).select(*MESSAGE_FIELDS))
    read = ingest.read_tracking(spark, lake)
    assert rows_of(read.select(*MESSAGE_FIELDS)) == want
    assert _files_read(read) <= 3 * 5 + 5  # a few files for each day and outcome
    assert len(list((tmp_path / "lake" / "log").glob("batch=*"))) <= 2 * 10
    assert len(list((tmp_path / "lake" / "index").glob("upto=*"))) <= 2
    store = incremental.FactStore(str(tmp_path / "store"))
    assert incremental.load_from_lake(spark, lake, job_dim, store)
    assert _stored(spark, store) == _end_state(spark, lake, job_dim)


def test_loads_between_compactions_miss_nothing(spark, messages, job_dim, tmp_path):
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    store = incremental.FactStore(str(tmp_path / "store"))
    for n in range(4):
        part = messages.filter(F.pmod(F.xxhash64("offset"), F.lit(4)) == n)
        part.coalesce(1).write.mode("append").parquet(source)
        ingest.start_ingest(stream_of(spark, source, MESSAGE), lake).awaitTermination()
        if n != 1:
            assert ingest.compact(spark, lake)
            assert not ingest.compact(spark, lake)
        if n % 2:
            assert incremental.load_from_lake(spark, lake, job_dim, store)
            assert _stored(spark, store) == _end_state(spark, lake, job_dim)
    bad = rejected(decode_messages(messages)).select("offset", "reject_reason", "raw")
    letters = ingest.read_dead_letters(spark, lake).select("offset", "reject_reason", "raw")
    assert rows_of(letters) == rows_of(bad)


def test_a_compaction_that_died_is_done_again(spark, messages, tmp_path, monkeypatch):
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    messages.coalesce(1).write.parquet(source)
    ingest.start_ingest(stream_of(spark, source, MESSAGE), lake).awaitTermination()
    before = rows_of(ingest.read_tracking(spark, lake))
    with monkeypatch.context() as patch:
        patch.setattr(batch_log, "_sweep", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            ingest.compact(spark, lake)
    assert rows_of(ingest.read_tracking(spark, lake)) == before
    (tmp_path / "lake" / "index" / "upto=0" / "_SUCCESS").unlink()
    assert rows_of(ingest.read_tracking(spark, lake)) == before
    assert ingest.compact(spark, lake)
    assert rows_of(ingest.read_tracking(spark, lake)) == before


LAYOUT = "create_time STRING, id BIGINT, dates DATE"


def test_first_copies_over_many_batches(spark, tmp_path):
    """Copies of a key in one batch and in later ones, a third of all rows on one key."""
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1500).cast("string").alias("create_time"),
        "id", F.lit(START).alias("received_at"), F.col("id").alias("offset"), F.lit(0).alias("partition"),
        F.lit(START.date()).alias("dates"),
    )
    for n in range(4):
        rows.filter(F.floor(F.col("id") / 750) == n).coalesce(2).write.mode("append").parquet(source)
        stream = stream_of(spark, source, rows.schema)
        dedup.start_first_copies(stream, path, LAYOUT).awaitTermination()
    want = rows.groupBy("create_time").agg(F.min("id").alias("id")).select("create_time", "id")
    got = dedup.read_first_copies(spark, path, LAYOUT)
    assert rows_of(got.select("create_time", "id")) == rows_of(want)
