"""Versioned loads: what readers see, what counts as changed, what is published, which files are read."""

import time

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from jobmetrics import schemas
from jobmetrics.jobs import load_fact
from jobmetrics.operators import reports
from jobmetrics.operators.numbering import with_surrogate
from jobmetrics.plans import versioned
from jobmetrics.plans.fact import FACT_COLUMNS, build_fact
from jobmetrics.sinks import versions
from jobmetrics.sinks.versions import VersionedStore
from jobmetrics.sources import file_ledger, fixtures
from jobmetrics.sources.tables import TRACKING_COLUMNS, Table

ROW = ["id", *FACT_COLUMNS, "updated_at"]


@pytest.fixture
def store(tmp_path):
    return VersionedStore(str(tmp_path / "store"))


@pytest.fixture(scope="module")
def facts(tracking, job_dim):
    """The cells of some events, computed once."""
    memory = {}

    def of(condition="true"):
        if condition not in memory:
            memory[condition] = build_fact(tracking.filter(condition), job_dim)
        return memory[condition]

    return of


def stored(spark, store, *columns):
    return rows_of(versioned.read_fact(spark, store).select(*(columns or FACT_COLUMNS)))


def days_in(spark, store):
    return {r["dates"] for r in versions.index(spark, store).filter("rows > 0").collect()}


def test_the_first_load_numbers_like_the_full_form(spark, store, facts):
    days = versioned.replace(spark, store, facts(), None)
    assert stored(spark, store, "id", *FACT_COLUMNS) == rows_of(with_surrogate(facts()).select("id", *FACT_COLUMNS))
    assert set(days) == days_in(spark, store)


def test_loading_the_same_again_changes_no_row_and_no_day(spark, store, facts):
    versioned.replace(spark, store, facts(), None)
    before, index = stored(spark, store, *ROW), rows_of(versions.index(spark, store))
    assert versioned.replace(spark, store, facts().repartition(3), None) == []
    assert stored(spark, store, *ROW) == before and rows_of(versions.index(spark, store)) == index
    # The load is known all the same.
    assert versions.current(spark, store) == 1


def test_only_what_differs_gets_a_new_time_and_ids_stay(spark, store, facts, tracking, job_dim):
    some, cell = "event_id % 2 = 0 OR event_ts >= timestamp'2024-01-25'", versioned.CELL
    versioned.replace(spark, store, facts(some), None)
    before = {tuple(r[c] for c in cell): r for r in versioned.read_fact(spark, store).collect()}
    time.sleep(0.01)
    # More events, and other bids of some clicks.
    dearer = F.when(F.expr("event_id % 4 = 0 AND event_ts < timestamp'2024-01-25'"), F.col("bid") + 1).otherwise(F.col("bid"))
    fresh = build_fact(tracking.withColumn("bid", dearer), job_dim)
    days = versioned.replace(spark, store, fresh, None)
    after = {tuple(r[c] for c in cell): r for r in versioned.read_fact(spark, store).collect()}
    assert stored(spark, store) == rows_of(fresh.select(*FACT_COLUMNS))
    assert days and all(d.day < 25 for d in days) and len({r["id"] for r in after.values()}) == len(after)
    kept = changed = 0
    for key, row in after.items():
        old = before.get(key)
        if old is None:
            continue
        assert row["id"] == old["id"]
        same = all(row[c] == old[c] for c in FACT_COLUMNS)
        assert (row["updated_at"] == old["updated_at"]) is same
        kept, changed = kept + same, changed + (not same)
    assert kept and changed and len(after) > len(before)


def test_readers_see_the_fact_before_or_after_a_load(spark, store, facts):
    half = "event_id % 2 = 0"
    versioned.replace(spark, store, facts(half), None)
    reader = versioned.read_fact(spark, store).select(*FACT_COLUMNS)
    versioned.replace(spark, store, facts(), None)
    assert rows_of(reader) == rows_of(facts(half).select(*FACT_COLUMNS))
    assert stored(spark, store) == rows_of(facts().select(*FACT_COLUMNS))


@pytest.mark.parametrize("step", ["stage", "commit"])
def test_a_load_that_dies_leaves_the_fact_as_it_was(spark, store, facts, monkeypatch, step):
    versioned.replace(spark, store, facts("event_id % 2 = 0"), None)
    before = stored(spark, store, *ROW)
    with monkeypatch.context() as patch:
        original = getattr(versions, step)

        def fail(*args):
            if step == "stage" and args[2] == versioned.FACTS:
                return original(*args)
            raise OSError("lost")

        patch.setattr(versions, step, fail)
        with pytest.raises(OSError):
            versioned.replace(spark, store, facts(), None)
    assert stored(spark, store, *ROW) == before and versions.current(spark, store) == 0
    versioned.replace(spark, store, facts(), None)
    assert stored(spark, store) == rows_of(facts().select(*FACT_COLUMNS))


def test_an_emptied_source_empties_the_fact_and_is_owed(spark, store, facts):
    days = versioned.replace(spark, store, facts("event_ts < timestamp'2024-01-04'"), None)
    versions.publish(spark, store, "w", versioned.FACTS, schemas.FACT, lambda *a: None)
    assert versions.owed(spark, store, "w") == []
    assert versioned.replace(spark, store, facts("false"), None) == days
    assert stored(spark, store) == [] and versions.owed(spark, store, "w") == days
    # Once empty, a day is not emptied again.
    assert versioned.replace(spark, store, facts("false"), None) == []


def test_versions_no_longer_named_are_removed(spark, store, facts, tmp_path):
    for n in range(4):
        versioned.replace(spark, store, facts(f"event_id % {n + 2} <> 0"), None)
    found = [len(list((tmp_path / "store" / t).glob("version=*"))) for t in ("facts", "daily", "index", "loads")]
    assert found == [2, 2, 2, 2]
    assert stored(spark, store) == rows_of(facts("event_id % 5 <> 0").select(*FACT_COLUMNS))


def test_daily_totals_follow_the_loads(spark, store, facts, tmp_path):
    for condition in ("event_id % 2 = 0", "event_id % 2 = 0 OR event_ts < timestamp'2024-01-03'", "event_ts > timestamp'2024-01-02'"):
        changed = versioned.replace(spark, store, facts(condition), None)
        folder = tmp_path / "store" / "daily" / f"version={versions.current(spark, store)}"
        assert {p.name for p in folder.glob("dates=*")} <= {f"dates={d}" for d in changed}
        for key in ("job_id", "campaign_id"):
            assert rows_of(versioned.read_daily(spark, store, key)) == rows_of(reports.daily(facts(condition), key))


def test_what_failed_to_be_published_is_owed_until_it_succeeds(spark, store, facts):
    first = versioned.replace(spark, store, facts("event_ts < timestamp'2024-01-05'"), None)
    written = []

    def fail(rows, days, whole):
        raise OSError("no warehouse")

    def write(rows, days, whole):
        written.append((days, whole, rows.count()))

    def publish(how):
        return versions.publish(spark, store, "events", versioned.FACTS, schemas.FACT, how)

    for _ in range(2):
        with pytest.raises(OSError):
            publish(fail)
    assert publish(write) == first and written.pop()[1] is True
    assert publish(write) == [] and not written
    # Two loads of other days, publishing failed after both: the next call owes the days of both.
    second = versioned.replace(spark, store, facts("event_ts < timestamp'2024-01-06'"), None)
    with pytest.raises(OSError):
        publish(fail)
    third = versioned.replace(spark, store, facts("event_ts < timestamp'2024-01-08' AND event_ts >= timestamp'2024-01-02'"), None)
    with pytest.raises(OSError):
        publish(fail)
    assert publish(write) == sorted({*second, *third}) and written[0][1] is False
    assert publish(write) == []


def _arrive(events, path):
    events.select(*TRACKING_COLUMNS).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def source(tmp_path):
    return Table("parquet", {"path": str(tmp_path / "events")})


def test_files_tell_which_days_to_compute(spark, tracking, job_dim, store, source, tmp_path, monkeypatch):
    """Late events of old days in new files; files of other days are not read."""
    reads, original = [], file_ledger.read_files
    monkeypatch.setattr(file_ledger, "read_files", lambda s, t, e, files: reads.append(sorted(files)) or original(s, t, e, files))

    def load():
        reads.clear()
        return versioned.load_from_files(spark, source, job_dim, store)

    late = "event_id % 50 = 7"
    parts = [f"event_ts < timestamp'2024-01-10' AND NOT {late}", f"event_ts >= timestamp'2024-01-10' AND NOT {late}", late]
    for n, part in enumerate(parts):
        _arrive(tracking.filter(part), source.options["path"])
        assert load()
        assert len(reads[0]) == 1 and len(reads[1]) == (1, 1, 3)[n]
        seen = " OR ".join(f"({p})" for p in parts[:n + 1])
        assert stored(spark, store) == rows_of(build_fact(tracking.filter(seen), job_dim))
        # Nothing new: the files are listed and none is read.
        assert load() is None and reads == []
    # A file is taken away: its days are computed from what is left.
    gone = [r["file"] for r in versioned._ledger(spark, store).collect() if len(r["days"]) < 15]
    before = versions.current(spark, store)
    for file in gone[:1]:
        (tmp_path / "events" / file.rpartition("/")[2]).unlink()
    spark.catalog.refreshByPath(source.options["path"])
    assert load() and reads[0] == [] and versions.current(spark, store) == before + 1
    assert stored(spark, store) == rows_of(build_fact(source.load(spark), job_dim))


def test_a_file_without_usable_events_is_read_once(spark, tracking, job_dim, store, source):
    _arrive(tracking.limit(5).withColumn("create_time", F.lit("no key")), source.options["path"])
    assert versioned.load_from_files(spark, source, job_dim, store) == []
    assert versioned.load_from_files(spark, source, job_dim, store) is None


def test_the_job_publishes_what_it_owes_without_new_events(spark, sf_dir, tracking, job_dim, tmp_path, monkeypatch):
    events, jobs, path = (str(tmp_path / n) for n in ("events", "jobs", "store"))
    fixtures.job(spark, sf_dir).write.parquet(jobs)
    argv = ["--events", f"path={events}", "--jobs", f"path={jobs}", "--store", path, "--versioned", "--warehouse", "jdbc:x"]
    calls, broken = [], [True]

    def send(name):
        def run(fact, target, *rest):
            if broken[0]:
                raise OSError("no warehouse")
            calls.append((name, rest[0] if name == "days" else None, fact.count()))
        return run

    monkeypatch.setattr(load_fact, "replace_fact_jdbc", send("whole"))
    monkeypatch.setattr(load_fact, "publish_days", send("days"))
    _arrive(tracking.filter("event_ts < timestamp'2024-01-05'"), events)
    for _ in range(2):
        with pytest.raises(OSError):
            load_fact.main(argv, spark)
    broken[0] = False
    assert load_fact.main(argv, spark) is False and [c[0] for c in calls] == ["whole"]
    _arrive(tracking.filter("event_ts >= timestamp'2024-01-05' AND event_ts < timestamp'2024-01-06'"), events)
    assert load_fact.main(argv, spark) is True
    assert calls[1][0] == "days" and [d.day for d in calls[1][1]] == [5]
    assert load_fact.main(argv, spark) is False and len(calls) == 2
    with pytest.raises(SystemExit):
        load_fact.parse([*argv, "--publish", "append"])
