from datetime import date, timedelta

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from jobmetrics.operators import audit, clean
from jobmetrics.operators.clean import decode_events
from jobmetrics.operators.numbering import with_surrogate
from jobmetrics.plans import incremental
from jobmetrics.plans.fact import FACT_COLUMNS, build_fact
from jobmetrics.sinks.fact_lake import read_fact
from jobmetrics.sources.tables import latest_event_time

COLUMNS = ["id", *FACT_COLUMNS]


@pytest.fixture
def store(tmp_path):
    return incremental.FactStore(str(tmp_path / "store"))


def stored(spark, store):
    return rows_of(read_fact(spark, store.facts).select(*COLUMNS))


def whole(tracking, job_dim):
    return rows_of(with_surrogate(build_fact(tracking, job_dim)).select(*COLUMNS))


def until(tracking, moment):
    return tracking.filter(F.col("event_ts") <= F.lit(moment).cast("timestamp"))


def test_loads_in_steps_equal_one_load(spark, tracking, job_dim, store):
    for moment in ("2024-01-03 00:00:00", "2024-01-03 11:30:00", "2024-01-20 07:30:00"):
        assert incremental.incremental_load(until(tracking, moment), job_dim, store)
        assert stored(spark, store) == whole(until(tracking, moment), job_dim)
    assert incremental.incremental_load(tracking, job_dim, store)
    assert stored(spark, store) == whole(tracking, job_dim)


def test_loading_twice_changes_nothing(spark, tracking, job_dim, store):
    part = until(tracking, "2024-01-05 12:00:00")
    assert incremental.incremental_load(part, job_dim, store)
    before = stored(spark, store)
    assert not incremental.incremental_load(part, job_dim, store)
    incremental.full_refresh(part, job_dim, store)
    assert stored(spark, store) == before


def test_load_that_died_before_its_record_is_repeated(spark, tracking, job_dim, store, monkeypatch):
    incremental.incremental_load(until(tracking, "2024-01-05 12:00:00"), job_dim, store)
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "_record", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            incremental.incremental_load(until(tracking, "2024-01-09 12:00:00"), job_dim, store)
    assert incremental.incremental_load(tracking, job_dim, store)
    assert stored(spark, store) == whole(tracking, job_dim)


def test_late_events_are_loaded_with_the_next_new_one(spark, tracking, job_dim, store):
    """Without a look-back a load is complete, however late an event is."""
    on_time = F.col("event_id") % 11 != 0
    first = until(tracking, "2024-01-10 12:00:00")
    incremental.incremental_load(first.filter(on_time), job_dim, store)
    incremental.incremental_load(tracking, job_dim, store)
    assert stored(spark, store) == whole(tracking, job_dim)
    assert incremental.days_of_last_load(spark, store) is None


def test_what_a_look_back_leaves_out_is_told(spark, tracking, job_dim, store):
    on_time = F.col("event_id") % 11 != 0
    first = until(tracking, "2024-01-10 12:00:00")
    incremental.incremental_load(first.filter(on_time), job_dim, store)
    incremental.incremental_load(tracking, job_dim, store, look_back=timedelta(days=2))
    fact = read_fact(spark, store.facts)
    late = clean.tracking_clean(first.filter(~on_time)).filter("ts < timestamp'2024-01-08'")
    late = clean.of_known_type(late).filter("job_id = floor(job_id)")
    want = {(r["d"], r["count"]) for r in late.groupBy(F.to_date("ts").alias("d")).count().collect()}
    found = audit.stale_days(tracking.drop("ts"), fact).collect()
    assert want and {(r["dates"], r["events"] - r["loaded"]) for r in found} == want


def test_days_before_the_look_back_are_left_alone(spark, tracking, job_dim, store):
    incremental.incremental_load(until(tracking, "2024-01-10 12:00:00"), job_dim, store)
    old = read_fact(spark, store.facts).filter("dates < date'2024-01-10'")
    before = rows_of(old.select("id", "updated_at"))
    incremental.incremental_load(tracking, job_dim, store, look_back=timedelta(0))
    spark.catalog.refreshByPath(store.facts)
    old = read_fact(spark, store.facts).filter("dates < date'2024-01-10'")
    assert rows_of(old.select("id", "updated_at")) == before
    assert stored(spark, store) == whole(tracking, job_dim)
    assert min(incremental.days_of_last_load(spark, store)) == date(2024, 1, 10)


def test_events_from_before_the_first_watermark_are_loaded(spark, tracking, job_dim, store):
    old = F.lit("13814000-1dd2-11b2-8000-000000000000")  # 1970
    rows = tracking.limit(50).withColumn("create_time", old)
    assert incremental.incremental_load(rows, job_dim, store)
    assert stored(spark, store) == whole(rows, job_dim)


def test_a_first_load_scans_the_events_once(spark, tracking, job_dim, store, tmp_path, monkeypatch):
    tracking.write.parquet(str(tmp_path / "events"))
    scans = []
    replace = incremental.replace_fact
    monkeypatch.setattr(incremental, "replace_fact", lambda rows, path: (
        scans.append(sum("FileScan" in line and "custom_track" in line
                         for line in plan_of(rows).splitlines())), replace(rows, path)))
    monkeypatch.setattr(incremental, "newest_countable", None)  # not asked for
    events = spark.read.parquet(str(tmp_path / "events"))
    assert incremental.incremental_load(events, job_dim, store)
    assert scans == [1]
    newest = clean.of_known_type(clean.tracking_clean(tracking)).agg(F.unix_micros(F.max("ts"))).first()[0]
    assert incremental.loaded_through(spark, store) == newest


def test_an_emptied_day_is_removed(spark, tracking, job_dim, store):
    incremental.incremental_load(until(tracking, "2024-01-10 12:00:00"), job_dim, store)
    gone = tracking.filter("to_date(event_ts) <> date'2024-01-09'")
    incremental.incremental_load(gone, job_dim, store, look_back=timedelta(days=3))
    assert stored(spark, store) == whole(gone, job_dim)


def test_event_from_the_future_does_not_stop_loads(spark, tracking, job_dim, store):
    future = F.when(F.col("event_id") == 5, F.lit("ffffffff-ffff-1fff-8000-000000000005"))
    odd = tracking.withColumn("create_time", F.coalesce(future, F.col("create_time")))
    incremental.incremental_load(until(odd, "2024-01-10 12:00:00"), job_dim, store)
    assert incremental.incremental_load(odd, job_dim, store, look_back=timedelta(days=9999))
    assert stored(spark, store) == whole(odd, job_dim)


def test_empty_source_loads_nothing(spark, tracking, job_dim, store):
    nothing = tracking.filter("false")
    assert not incremental.incremental_load(nothing, job_dim, store)
    assert incremental.loaded_through(spark, store) is None
    incremental.incremental_load(tracking, job_dim, store)
    assert not incremental.incremental_load(nothing, job_dim, store)


def test_gate(spark, tracking):
    def one(ts):
        return spark.sql(f"select {ts} as max_ts")

    newest = latest_event_time(tracking)
    earlier, never = one("timestamp'2024-01-01'"), one("cast(null as timestamp)")
    assert incremental.gate(newest, earlier).first()["has_new"] is True
    assert incremental.gate(newest, newest).first()["has_new"] is False
    assert incremental.gate(never, earlier).first()["has_new"] is False


def test_watermark_of_an_empty_fact(spark):
    empty = spark.createDataFrame([], "updated_at timestamp")
    row = incremental.fact_watermark(empty).select(F.col("max_ts").cast("string")).first()
    assert row[0] == "1998-01-01 00:00:00"


def test_row_at_the_watermark_is_not_new(spark, tracking):
    decoded = decode_events(tracking.drop("ts"))
    moment = decoded.filter("event_id = 500").first()["event_ts"]
    newer = incremental.rows_after(decoded, F.lit(moment))
    assert newer.filter("event_id = 500").count() == 0
    assert newer.filter("event_id = 501").count() == 1


def test_only_touched_days_are_read_from_a_lake(spark, tracking, tmp_path):
    lake = str(tmp_path / "lake")
    days = tracking.withColumn("dates", F.to_date("event_ts"))
    days.hint("rebalance", "dates").write.partitionBy("dates").parquet(lake)
    # 2024-01-25 00:00:00 UTC
    recent = incremental.events_since_day(spark.read.parquet(lake), 1706140800000000 + 12345)
    assert "dates" in plan_of(recent).split("PartitionFilters: [")[1].split("]")[0]
    assert recent.count() == tracking.filter("event_ts >= timestamp'2024-01-25'").count()
