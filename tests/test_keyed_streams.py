"""Streams with keyed state, and the gate before them, against the batch form."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_streaming import MESSAGE, START, _feed, _sent, messages, stream_of  # noqa: F401

from jobmetrics.operators.clean import tracking_clean
from jobmetrics.operators.metrics import hourly_metrics
from jobmetrics.operators.upsert import latest_by_key
from jobmetrics.schemas import MESSAGE_FIELDS
from jobmetrics.streaming import gate, keyed
from jobmetrics.streaming.batch_log import compacted_upto, last_batch
from jobmetrics.streaming.decode import accepted, decode_messages
from jobmetrics.streaming.dedup import first_by_key

LAYOUT = ", ".join(f"{n} {'STRING' if n in ('create_time', 'custom_track', 'ts') else 'DOUBLE'}" for n in MESSAGE_FIELDS) + ", dates DATE"


def good(df):
    return accepted(decode_messages(df))


def batch_cells(events):
    return rows_of(hourly_metrics(tracking_clean(latest_by_key(events).select(*MESSAGE_FIELDS))))


def ids_of(events):
    return events.select("partition", "offset")


def test_cells_from_changes_equal_the_batch_form_in_any_order(spark, messages, tmp_path):
    """Seven batches in no order of time: resends come before what they replace, and late events after all others."""
    source, path = str(tmp_path / "in"), str(tmp_path / "cells")
    _feed(messages, source, 7)
    query = keyed.start_hourly_changes(good(stream_of(spark, source, MESSAGE, maxFilesPerTrigger=1)), path, compact_every=3)
    query.awaitTermination()
    assert last_batch(spark, path) == 6 and compacted_upto(spark, path) == 5
    assert rows_of(keyed.read_hourly_changes(spark, path)) == batch_cells(good(messages))
    # Each batch wrote changes of its own size; none read the days again.
    assert sum(p["numInputRows"] for p in query.recentProgress) == messages.count()
    assert keyed.compact(spark, path) and not keyed.compact(spark, path)
    assert rows_of(keyed.read_hourly_changes(spark, path)) == batch_cells(good(messages))


def _arrive(spark, source, path, rows):
    spark.createDataFrame(_sent(rows), MESSAGE).coalesce(1).write.mode("append").parquet(source)
    keyed.start_hourly_changes(good(stream_of(spark, source, MESSAGE)), path).awaitTermination()
    cells = keyed.read_hourly_changes(spark, path).collect()
    return {(r["job_id"], r["date"].day, r["hour"]): r["clicks"] for r in cells}


def test_versions_take_back_what_they_replace(spark, tmp_path):
    """(hour of the event, number, job, hours until received, offset)"""
    source, path = str(tmp_path / "in"), str(tmp_path / "cells")
    assert _arrive(spark, source, path, [(0.1, 1, 5, 0, 0), (0.2, 2, 5, 0, 1)]) == {(5, 1, 0): 2}
    # The job changes: one cell loses the event, another gets it. The same message again changes nothing.
    assert _arrive(spark, source, path, [(0.2, 2, 6, 1, 2), (0.1, 1, 5, 0, 0)]) == {(5, 1, 0): 1, (6, 1, 0): 1}
    # An older version comes late, and a month-old event too.
    assert _arrive(spark, source, path, [(0.2, 2, 7, 0.5, 3), (0.3, 3, 5, 700, 4)]) == {(5, 1, 0): 2, (6, 1, 0): 1}
    # Without a job it counts nowhere; given one again it does.
    assert _arrive(spark, source, path, [(0.2, 2, None, 3, 5)]) == {(5, 1, 0): 2}
    assert _arrive(spark, source, path, [(0.2, 2, 6, 4, 6), (0.1, 1, 5, 4, 7)]) == {(5, 1, 0): 2, (6, 1, 0): 1}


def test_one_key_with_a_third_of_all_messages(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "cells")
    rows = [(0.1, 1 if i % 3 == 0 else i, 5, i / 1000, i) for i in range(600)]
    for n in range(3):
        got = _arrive(spark, source, path, rows[n * 200:(n + 1) * 200])
    assert got == {(5, 1, 0): 400}


def test_a_batch_done_again_adds_nothing(spark, messages, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "cells")
    _feed(messages, source, 2)

    def run():
        stream = good(stream_of(spark, source, MESSAGE, maxFilesPerTrigger=1))
        keyed.start_hourly_changes(stream, path).awaitTermination()
        return rows_of(keyed.read_hourly_changes(spark, path))

    before = run()
    for name in ("1", ".1.crc"):
        commit = tmp_path / "cells" / "checkpoint" / "commits" / name
        if commit.exists():
            commit.unlink()
    assert run() == before == batch_cells(good(messages))


def test_first_copies_whole_over_many_batches(spark, messages, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "first")
    ordered = messages.orderBy("received_at", "offset").withColumn("n", F.monotonically_increasing_id())
    total = messages.count()
    rows = ordered.coalesce(1).withColumn("n", F.monotonically_increasing_id()).select("*", F.floor(F.col("n") * 5 / total).alias("wave"))
    for n in range(5):
        rows.filter(F.col("wave") == n).select(*messages.columns).write.mode("append").parquet(source)
    keyed.start_first_copies(good(stream_of(spark, source, MESSAGE, maxFilesPerTrigger=1)), path, LAYOUT).awaitTermination()
    got = keyed.read_first_copies(spark, path, LAYOUT).select(*MESSAGE_FIELDS)
    assert rows_of(got) == rows_of(first_by_key(good(messages)).select(*MESSAGE_FIELDS))


@pytest.fixture
def gated(spark, messages, tmp_path):
    """Messages by the time they were received, in ten batches, through the gate."""
    source, path = str(tmp_path / "in"), str(tmp_path / "gate")
    day = F.floor(F.datediff("received_at", F.lit(START.date())) / 3)
    for n in range(-1, 11):
        part = messages.filter(day == n)
        if not part.isEmpty():
            part.coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = good(stream_of(spark, source, MESSAGE, maxFilesPerTrigger=1))
        gate.start_gate(stream, path, "30 minutes").awaitTermination()
        return path

    return run


def test_what_passes_and_what_is_late_is_what_was_sent(spark, messages, gated, tmp_path):
    path = gated()
    by_outcome = {r["outcome"]: r["n"] for r in gate.counts(spark, path).groupBy("outcome").agg(F.sum("messages").alias("n")).collect()}
    assert by_outcome["open"] + by_outcome["late"] == good(messages).count() and by_outcome["late"] > 1
    late = gate.late_events(spark, path)
    assert late.filter("date_trunc('hour', event_time) + interval 1 hour > clock OR reason <> 'hour closed'").isEmpty()
    # The clock of a batch is the newest event before it, less the delay.
    marks = {r["batch"]: r["newest"] for r in spark.read.parquet(f"{path}/marks").collect()}
    for row in late.select("batch", F.expr("clock + interval 30 minutes").alias("newest")).distinct().collect():
        assert row["newest"] == max(at for batch, at in marks.items() if at and batch < row["batch"])


def test_state_of_closed_hours_is_given_up_and_no_event_is_lost(spark, messages, gated, tmp_path):
    path, cells = gated(), str(tmp_path / "cells")
    late = gate.late_events(spark, path)
    passed = good(messages).join(ids_of(late), ["partition", "offset"], "left_anti")
    query = keyed.start_hourly_changes(gate.open_events(spark, path, maxFilesPerTrigger="4"), cells)
    query.awaitTermination()
    assert rows_of(keyed.read_hourly_changes(spark, cells)) == batch_cells(passed)
    states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert len(states) > 4 and sum(s["numRowsDroppedByWatermark"] for s in states) == 0
    keys = passed.select("create_time").distinct().count()
    assert max(s["numRowsTotal"] for s in states) < keys / 2 and sum(s["numRowsRemoved"] for s in states) > keys / 2
    first = str(tmp_path / "first")
    keyed.start_first_copies(gate.open_events(spark, path, maxFilesPerTrigger="4"), first, LAYOUT).awaitTermination()
    assert rows_of(keyed.read_first_copies(spark, first, LAYOUT).select("create_time")) == rows_of(passed.select("create_time").distinct())


def test_a_gated_batch_done_again_has_the_same_clock(spark, messages, gated, tmp_path):
    path = gated()
    before = rows_of(gate.late_events(spark, path).drop("dates"))
    last = last_batch(spark, path)
    for name in (f"{last}", f".{last}.crc"):
        commit = tmp_path / "gate" / "checkpoint" / "commits" / name
        if commit.exists():
            commit.unlink()
    gated()
    assert last_batch(spark, path) == last and rows_of(gate.late_events(spark, path).drop("dates")) == before


@pytest.mark.parametrize("start", [keyed.start_hourly_changes, lambda e, path: keyed.start_first_copies(e, path, LAYOUT)])
def test_keys_of_an_hour_share_a_bounded_number_of_groups(spark, tmp_path, start):
    """A call of Python, and a row of the state store, a group: not one a key."""
    source, rows = str(tmp_path / "in"), [(0.1 + i / 1000, i, 5, 0, i) for i in range(800)]
    spark.createDataFrame(_sent(rows), MESSAGE).coalesce(1).write.parquet(source)
    query = start(good(stream_of(spark, source, MESSAGE)), str(tmp_path / "out"))
    query.awaitTermination()
    states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert max(s["numRowsTotal"] for s in states) <= keyed.PARTS_OF_HOUR
