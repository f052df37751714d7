"""Random events against a plain Python count."""

import math
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from jobmetrics.functions.time_uuid import ts_to_uuid
from jobmetrics.operators.clean import tracking_clean
from jobmetrics.operators.metrics import hourly_metrics, hourly_metrics_joined
from jobmetrics.operators.upsert import latest_by_key

TYPES = ["click", "conversion", "qualified", "unqualified", "view", None]
NAMES = {"conversion": "conversions", "qualified": "qualified", "unqualified": "unqualified"}


def _events(seed, n=1500):
    rng = random.Random(seed)

    def number(choices):
        return rng.choice([None, float("nan"), -0.0, *choices])

    return [
        (
            datetime(2024, 2, 28, 22) + timedelta(seconds=rng.randrange(4 * 3600)),
            i,
            number([1.0, 1.0, 1.0, 2.0]),
            rng.choice(TYPES),
            number([0.25, 1.5]),
            number([3.0]),
            number([4.0]),
            number([5.0, 6.0]),
        )
        for i, _ in enumerate(range(n))
    ]


def _fill(value):
    return 0.0 if value is None or math.isnan(value) else value + 0.0


def _expected(rows):
    cells = defaultdict(lambda: defaultdict(float))
    for at, _, job, kind, bid, campaign, group, publisher in rows:
        if job is None or kind not in TYPES[:4]:
            continue
        key = (_fill(job), at.date(), at.hour, _fill(publisher), _fill(campaign), _fill(group))
        cells[key][kind] += 1
        if kind == "click":
            cells[key]["spend"] += _fill(bid)
    out = {}
    for key, cell in cells.items():
        clicks = cell.get("click")
        spend = cell["spend"] if clicks else None
        out[key] = (
            spend / clicks if clicks else None, clicks, spend,
            *(cell.get(kind) for kind in NAMES),
        )
    return out


@pytest.mark.parametrize("form", [hourly_metrics, hourly_metrics_joined])
@pytest.mark.parametrize("seed", [1, 2])
def test_hourly_metrics(spark, form, seed):
    rows = _events(seed)
    df = spark.createDataFrame(
        rows, "at timestamp_ntz, n long, job_id double, custom_track string, bid double, "
        "campaign_id double, group_id double, publisher_id double",
    )
    key = ts_to_uuid(F.col("at").cast("timestamp"), F.col("n"))
    cells = form(tracking_clean(df.withColumn("create_time", key))).collect()
    got = {
        (r["job_id"] + 0.0, r["date"], r["hour"], r["publisher_id"], r["campaign_id"],
         r["group_id"]): (r["bid_set"], r["clicks"], r["spend_hour"], r["conversions"],
                          r["qualified"], r["unqualified"])
        for r in cells
    }
    assert len(got) == len(cells)
    want = _expected(rows)
    assert got.keys() == want.keys()
    for cell, values in want.items():
        assert got[cell] == pytest.approx(values)


def test_last_write(spark):
    rng = random.Random(3)
    rows = [
        (str(rng.randrange(200)), rng.choice([None, 1.0, 2.0]),
         datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(50)), i // 4, i % 4)
        for i in range(2000)
    ]
    df = spark.createDataFrame(
        rows, "create_time string, bid double, received_at timestamp_ntz, offset long, "
        "partition int",
    )
    want = {}
    for row in sorted(rows, key=lambda r: r[2:]):
        want[row[0]] = row[1]
    got = {r["create_time"]: r["bid"] for r in latest_by_key(df.repartition(7)).collect()}
    assert got == want
