"""Load a CSV export of events into an event table by day, and set aside what does not fit.

    spark-submit --py-files jobmetrics.zip jobmetrics/jobs/load_csv.py \\
        --csv s3a://bucket/export.csv --events s3a://bucket/event_table --rejects s3a://bucket/rejects

The event table is one that the load job takes with ``--events path=...``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession, functions as F

from jobmetrics.functions.time_uuid import uuid_to_ts
from jobmetrics.session import build_session
from jobmetrics.sources import csv
from jobmetrics.sources.tables import read_if_present


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> tuple[int, int]:
    """Rows loaded, and rows set aside."""
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--csv", required=True)
    parser.add_argument("--events", required=True, help="path of the event table, by day")
    parser.add_argument("--rejects", required=True, help="path for rows that do not fit")
    parser.add_argument("--multi-line", action="store_true", help="values may hold line breaks")
    args = parser.parse_args(argv)
    spark = spark or build_session("load-csv")
    good = csv.csv_load(spark, args.csv, args.multi_line)
    by_day = good.withColumn("dates", F.to_date(uuid_to_ts(F.col("create_time"))))
    before = count(spark, args.events), count(spark, args.rejects)
    by_day.hint("rebalance", "dates").write.mode("append").partitionBy("dates").parquet(args.events)
    csv.csv_rejects(spark, args.csv, args.multi_line).write.mode("append").parquet(args.rejects)
    loaded, rejected = (count(spark, p) - b for p, b in zip((args.events, args.rejects), before))
    print(f"loaded {loaded} rows, set {rejected} aside")
    return loaded, rejected


def count(spark: SparkSession, path: str) -> int:
    rows = read_if_present(spark, path, "create_time STRING")
    return 0 if rows is None else rows.count()


if __name__ == "__main__":
    main()
