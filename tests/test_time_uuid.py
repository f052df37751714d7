import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from jobmetrics.functions.time_uuid import is_time_uuid, ts_to_uuid, uuid_to_ts



def _decode(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "u string")
    out = df.select("u", F.unix_micros(uuid_to_ts(F.col("u"))).alias("us"))
    return {r["u"]: r["us"] for r in out.collect()}


def _micros(steps: int) -> int:
    return (steps // 10) - 12219292800000000


def test_fresh_uuids_decode_to_the_microsecond(spark):
    values = [uuid.uuid1() for _ in range(2000)]
    got = _decode(spark, [str(v) for v in values])
    assert got == {str(v): _micros(v.time) for v in values}


def test_spread_of_times_decodes(spark):
    # Counts over the whole 60-bit range, with every last digit.
    steps = [0, 1, 9, 10, 122192928000000000 - 1, 122192928000000000, 2**60 - 1]
    steps += [(2**60 // 997) * i + i % 10 for i in range(997)]
    values = [
        uuid.UUID(fields=(s & 0xFFFFFFFF, (s >> 32) & 0xFFFF, (s >> 48) & 0x0FFF | 0x1000,
                          0x80, 0, 5))
        for s in steps
    ]
    got = _decode(spark, [str(v) for v in values])
    assert got == {str(v): _micros(v.time) for v in values}


@pytest.mark.parametrize(
    "text, expected",
    [
        ("13814000-1dd2-11b2-8000-000000000000", "1970-01-01 00:00:00"),
        ("00000000-0000-1000-8000-000000000000", "1582-10-15 00:00:00"),
        ("13814000-1DD2-11B2-8000-000000000000", "1970-01-01 00:00:00"),
    ],
)
def test_known_times(spark, text, expected):
    df = spark.createDataFrame([(text,)], "u string")
    assert df.select(uuid_to_ts(F.col("u")).cast("string")).first()[0] == expected


def test_other_values_decode_to_null(spark):
    bad = [str(uuid.uuid4()), "", "short", "zz814000-1dd2-11b2-8000-000000000000",
           "13814000-1dd2-11b2-8000-00000000000", None, "13814000-1dd2-11b2-8000-000000000000 ",
           "138140001dd211b28000000000000000", "13814000-1dd2-11b2-8000-000000000000\n"]
    df = spark.createDataFrame([(v,) for v in bad], "u string")
    u = F.col("u")
    assert df.filter(is_time_uuid(u) | uuid_to_ts(u).isNotNull()).count() == 0


def test_round_trip(spark):
    start = datetime(2024, 2, 29, 23, 59, 59, 999999)
    times = [(start + timedelta(microseconds=7919 * i), i) for i in range(500)]
    df = spark.createDataFrame(times, "t timestamp_ntz, n long").withColumn(
        "t", F.col("t").cast("timestamp")
    )
    encoded = df.withColumn("u", ts_to_uuid(F.col("t"), F.col("n")))
    assert encoded.filter(uuid_to_ts(F.col("u")) != F.col("t")).count() == 0
    assert encoded.select("u").distinct().count() == 500
    for row in encoded.select("u", F.unix_micros("t").alias("us")).collect():
        assert _micros(uuid.UUID(row["u"]).time) == row["us"]
        assert uuid.UUID(row["u"]).version == 1


def test_text_order_is_not_time_order(spark, tracking):
    newest = tracking.agg(F.max(F.struct("event_ts", "create_time"))).first()[0]["create_time"]
    assert newest != tracking.agg(F.max("create_time")).first()[0]
