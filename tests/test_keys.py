"""Upsert, numbering and draws, also with very uneven keys."""

from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from jobmetrics.functions.values import not_a_number, text_to_double, weighted_choice
from jobmetrics.operators.numbering import assign_by_draw, dense_index, with_surrogate
from jobmetrics.operators.upsert import latest_by_key, upsert
from jobmetrics.plans.fact import build_fact

VERSIONS = "create_time string, bid double, received_at timestamp, offset long, partition int"


def _version(key, bid, second, offset, partition=0):
    from datetime import datetime

    return (key, bid, datetime(2024, 1, 1, 0, 0, second), offset, partition)


def test_last_write_wins_also_with_null(spark):
    old = spark.createDataFrame([_version("a", 1.0, 0, 1), _version("b", 1.0, 0, 2)], VERSIONS)
    new = spark.createDataFrame(
        [_version("a", None, 5, 3), _version("c", 1.0, 5, 4), _version("c", 2.0, 5, 5),
         _version("b", 9.0, 0, 1)], VERSIONS
    )
    merged = {r["create_time"]: r["bid"] for r in upsert(old, new).collect()}
    assert merged == {"a": None, "b": 1.0, "c": 2.0}


def test_copies_of_one_moment_are_ordered_by_partition(spark):
    rows = spark.createDataFrame([_version("a", float(p), 5, 3, p) for p in range(4)], VERSIONS)
    for parts in (1, 4):
        assert latest_by_key(rows.repartition(parts)).first()["bid"] == 3.0


def test_upsert_twice_is_upsert_once(spark):
    new = spark.createDataFrame([_version("a", 2.0, 5, 3), _version("b", 1.0, 4, 2)], VERSIONS)
    once = upsert(new, new)
    assert rows_of(upsert(once, new)) == rows_of(once)


def test_copies_of_a_key_are_dropped_before_the_shuffle(spark):
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
        .alias("create_time"),
        F.col("id").cast("double").alias("bid"),
        F.timestamp_seconds(F.col("id")).alias("received_at"),
        F.col("id").alias("offset"),
        F.lit(0).alias("partition"),
    )
    latest = latest_by_key(hot)
    plan = plan_of(latest)
    before_shuffle = plan[plan.index("Exchange hashpartitioning(create_time"):]
    assert "Partial" in before_shuffle and "WindowGroupLimit" in before_shuffle
    assert latest.count() == 20001
    assert latest.filter("create_time = 'hot'").first()["bid"] == 29997.0


def test_surrogate_is_unique_and_reproducible(tracking, job_dim):
    fact = build_fact(tracking, job_dim)
    ids = with_surrogate(fact)
    assert ids.select("id").distinct().count() == fact.count()
    shuffled = with_surrogate(fact.repartition(7))
    cell = ["id", "job_id", "dates", "hours", "publisher_id", "campaign_id", "group_id"]
    assert rows_of(ids.select(*cell)) == rows_of(shuffled.select(*cell))
    # Other days do not change the numbers.
    some = with_surrogate(fact.filter("dates > date'2024-01-15'"))
    assert rows_of(some.select(*cell)) == rows_of(
        ids.filter("dates > date'2024-01-15'").select(*cell)
    )


def test_dense_index_has_no_gaps(spark):
    numbered, total = dense_index(spark.range(1000).withColumnRenamed("id", "k"), "k")
    assert sorted(r["index"] for r in numbered.collect()) == list(range(1000))
    assert total.first()[0] == 1000


def test_assignment_covers_all_choices_evenly(spark):
    rows = spark.range(1000)
    choices = spark.range(10, 17).withColumnRenamed("id", "publisher_id")
    counts = assign_by_draw(rows, F.col("id"), choices, "publisher_id").groupBy("publisher_id")
    sizes = {r["publisher_id"]: r["count"] for r in counts.count().collect()}
    assert set(sizes) == set(range(10, 17)) and set(sizes.values()) <= {142, 143}


def test_assignment_without_choices_is_null(spark):
    none = spark.range(0).withColumnRenamed("id", "publisher_id")
    out = assign_by_draw(spark.range(5), F.col("id"), none, "publisher_id")
    assert out.count() == 5 and out.filter("publisher_id is not null").count() == 0


def test_weighted_choice_shares(spark):
    draws = spark.range(100).select(
        weighted_choice(F.col("id"), ["a", "b", "c"], [70, 20, 10]).alias("c")
    )
    assert {r["c"]: r["count"] for r in draws.groupBy("c").count().collect()} == {
        "a": 70, "b": 20, "c": 10
    }


def test_numbers_in_text(spark):
    good = {"3": 3.0, " 3.5 ": 3.5, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "-0": -0.0,
            "true": 1.0, "false": 0.0, "inf": float("inf"), "-Infinity": float("-inf")}
    bad = ["abc", "", "1d", "0x10", "1 2", "{}", "--1", "1e", "None"]
    text = F.col("t")
    df = spark.createDataFrame([(t,) for t in [*good, *bad, None, '"NaN"']], "t string")
    got = {r["t"]: r["v"] for r in df.select("t", text_to_double(text).alias("v")).collect()}
    assert {t: got[t] for t in good} == good
    assert str(got['"NaN"']) == "nan"
    refused = {r["t"] for r in df.filter(not_a_number(text)).collect()}
    assert refused == set(bad)
