import uuid

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from jobmetrics.functions.time_uuid import ts_to_uuid
from jobmetrics.operators import audit, clean, enrich, metrics, numbering, reports
from jobmetrics.operators.numbering import with_surrogate
from jobmetrics.plans.fact import FACT_COLUMNS, build_fact

NAN = float("nan")
LAYOUT = ("at string, job_id double, custom_track string, bid double, campaign_id double, "
          "group_id double, publisher_id double")


def make(spark, rows):
    df = spark.createDataFrame(rows, LAYOUT)
    key = ts_to_uuid(F.to_timestamp("at"), F.monotonically_increasing_id())
    return df.withColumn("create_time", key).drop("at")


def test_ids_are_filled_and_jobless_rows_dropped(spark):
    rows = make(spark, [
        ("2024-01-01 10:00:00", None, "click", 1.0, 1.0, 1.0, 1.0),
        ("2024-01-01 10:00:00", NAN, "click", NAN, None, NAN, None),
        ("2024-01-01 10:00:00", -0.0, "click", None, 0.0, -0.0, 0.0),
        ("2024-01-01 10:00:00", 0.0, "conversion", None, 0.0, 0.0, NAN),
    ])
    out = clean.tracking_clean(rows)
    assert out.count() == 3
    assert out.filter("custom_track = 'conversion' and bid is not null").count() == 0
    cells = metrics.hourly_metrics(out).collect()
    assert len(cells) == 1
    cell = cells[0]
    assert (cell["job_id"], cell["publisher_id"], cell["group_id"]) == (0.0, 0.0, 0.0)
    assert (cell["clicks"], cell["conversions"], cell["qualified"]) == (2, 1, None)
    assert (cell["bid_set"], cell["spend_hour"]) == (0.0, 0.0)


def test_unusable_keys_are_left_out_and_counted(spark):
    rows = make(spark, [("2024-01-01 10:00:00", 1.0, "click", 1.0, 1.0, 1.0, 1.0)])
    bad = [None, "short", str(uuid.uuid4())]
    for key in bad:
        rows = rows.unionByName(
            rows.limit(1).withColumn("create_time", F.lit(key).cast("string"))
        )
    assert clean.tracking_clean(rows).count() == 1
    states = {r["key_state"]: r["row_count"] for r in audit.key_audit(rows).collect()}
    assert states == {"time_uuid": 1, "missing": 1, "not_time_uuid": 2}


def test_missing_bids_count_in_the_average(spark):
    rows = make(spark, [
        ("2024-01-01 10:00:00", 1.0, "click", bid, 1.0, 1.0, 1.0) for bid in (4.0, None, 2.0)
    ])
    cell = metrics.hourly_metrics(clean.tracking_clean(rows)).first()
    assert (cell["bid_set"], cell["clicks"], cell["spend_hour"]) == (2.0, 3, 6.0)


def test_hour_edges_and_unknown_types(spark):
    rows = make(spark, [
        ("2024-01-01 23:59:59.999999", 1.0, "qualified", None, 1.0, 1.0, 1.0),
        ("2024-01-02 00:00:00", 1.0, "unqualified", None, 1.0, 1.0, 1.0),
        ("2024-01-02 00:00:00", 1.0, "view", None, 1.0, 1.0, 1.0),
        ("2024-01-02 00:00:00", 1.0, None, None, 1.0, 1.0, 1.0),
        ("2024-01-02 00:00:00", 1.0, "Click", None, 1.0, 1.0, 1.0),
    ])
    ready = clean.tracking_clean(rows)
    cells = {
        (str(r["date"]), r["hour"]): (
            r["clicks"], r["spend_hour"], r["qualified"], r["unqualified"]
        )
        for r in metrics.hourly_metrics(ready).collect()
    }
    assert cells == {
        ("2024-01-01", 23): (None, None, 1, None),
        ("2024-01-02", 0): (None, None, None, 1),
    }
    left_out = {r["custom_track"]: r["events"] for r in audit.unrecognized_events(ready).collect()}
    assert left_out == {"view": 1, None: 1, "Click": 1}


def test_single_pass_equals_joins(tracking):
    ready = clean.tracking_clean(tracking.drop("ts"))
    single = metrics.hourly_metrics(ready)
    assert rows_of(single) == rows_of(metrics.hourly_metrics_joined(ready))


def test_fact_keeps_unknown_jobs_and_event_ids(spark, tracking, job_dim):
    fact = build_fact(tracking, job_dim)
    assert fact.columns == FACT_COLUMNS
    kinds = dict(fact.dtypes)
    assert {kinds[c] for c in ("job_id", "company_id", "group_id")} == {"bigint"}
    # Jobs 1 to 150 are in the dimension.
    assert fact.filter("(company_id is null) != (job_id not between 1 and 150)").count() == 0
    assert fact.filter("company_id is null").count() > 0
    hourly = metrics.hourly_metrics(clean.tracking_clean(tracking.drop("ts")))
    assert fact.count() == hourly.filter("job_id = floor(job_id)").count()


def test_fractional_ids_do_not_match_a_job(spark):
    rows = make(spark, [("2024-01-01 10:00:00", 1.5, "click", 1.0, 1.0, 1.0, 1.0)])
    dim = spark.createDataFrame([(1, 7, 1, 1)], "job_id int, company_id int, group_id int, "
                                "campaign_id int")
    assert build_fact(rows, dim).count() == 0


def test_no_id_is_cut_and_those_that_are_none_are_listed(spark, job_dim):
    jobs = (3e9, 4e9, 1.2, 1.7, float("inf"), -float("inf"), 1e300, 1e18, 5.0)
    rows = make(spark, [("2024-01-01 10:00:00", job, "click", 1.0, 1.0, 1.0, 1.0) for job in jobs])
    fact = with_surrogate(build_fact(rows, job_dim))
    found = sorted((r["job_id"], r["id"]) for r in fact.collect())
    assert [job for job, _ in found] == [5, 3 * 10**9, 4 * 10**9, 10**18]
    assert found == sorted((r["job_id"], r["id"]) for r in fact.repartition(5).collect())
    rejected = audit.rejected_ids(clean.tracking_clean(rows)).collect()
    assert {(r["job_id"], r["events"], r["reason"]) for r in rejected} == {
        (job, 1, "job_id") for job in jobs if job not in (3e9, 4e9, 1e18, 5.0)
    }


def test_an_hour_with_too_many_cells_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(numbering, "IDS_PER_HOUR", 300)
    cells = spark.range(5000).select(
        F.lit("2024-01-01").cast("date").alias("dates"), F.lit(5).alias("hours"), F.col("id").alias("job_id"),
        *[F.lit(1).alias(c) for c in ("publisher_id", "campaign_id", "group_id")],
    )
    with pytest.raises(Exception, match="room for 300 ids"):
        with_surrogate(cells).collect()


def test_empty_input(spark, job_dim):
    empty = make(spark, [])
    assert build_fact(empty, job_dim).count() == 0
    assert reports.latest_hours(build_fact(empty, job_dim)).count() == 0


def test_daily_sums_equal_hourly_sums(tracking, job_dim):
    fact = build_fact(tracking, job_dim)
    for key in ("job_id", "campaign_id", "publisher_id"):
        daily = reports.daily(fact, key)
        for name in reports.COUNTS:
            assert daily.agg(F.sum(name)).first()[0] == fact.agg(F.sum(name)).first()[0]
        off = daily.filter(F.abs(F.col("bid_set") * F.col("clicks") - F.col("spend")) > 1e-6)
        assert off.count() == 0


def test_funnel_of_nothing_is_null(spark):
    fact = spark.createDataFrame(
        [(1, None, 2, None, None, None)],
        "job_id int, clicks long, conversion long, qualified_application long, "
        "disqualified_application long, spend_hour double",
    )
    row = reports.funnel(fact, "job_id").first()
    assert row["conversion_rate"] is None and row["qualified_share"] is None
    assert (row["clicks"], row["conversion"], row["spend_per_conversion"]) == (0, 2, 0.0)


def test_mismatch_is_null_safe(spark):
    rows = make(spark, [
        ("2024-01-01 10:00:00", 1.0, "click", 1.0, 5.0, 6.0, 1.0),
        ("2024-01-01 10:00:00", 2.0, "click", 1.0, 5.0, 6.0, 1.0),
        ("2024-01-01 10:00:00", 3.0, "click", 1.0, 5.0, 6.0, 1.0),
    ])
    dim = spark.createDataFrame(
        [(1, 9, 6, 5), (2, 9, None, 5), (4, 9, 1, 1)],
        "job_id int, company_id int, group_id int, campaign_id int",
    )
    found = enrich.id_mismatch(clean.tracking_clean(rows), dim).collect()
    assert [(r["job_id"], r["events"], r["job_group_id"]) for r in found] == [(2.0, 1, None)]
