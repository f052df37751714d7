"""Load the hourly fact from the event table.

    spark-submit --py-files jobmetrics.zip jobmetrics/jobs/load_fact.py \\
        --store s3a://bucket/fact \\
        --lake s3a://bucket/events --jobs format=jdbc url=... driver=... dbtable=job user=...

The event table is a lake written by the ingest job (``--lake``) or any table Spark can read
(``--events``). Settings are ``key=value`` pairs; ``format`` names the source format, all
others are its options.
"""

from __future__ import annotations

import argparse
import hashlib
import os
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmetrics import schemas
from jobmetrics.operators.enrich import job_dimension
from jobmetrics.plans import incremental, versioned
from jobmetrics.session import build_session, size_shuffles
from jobmetrics.sinks import versions
from jobmetrics.sinks.catalog import ensure_fact
from jobmetrics.sinks.fact_lake import read_fact
from jobmetrics.sinks.files import bytes_in
from jobmetrics.sinks.warehouse import publish_days, replace_fact_jdbc, write_fact_jdbc
from jobmetrics.sinks.versions import VersionedStore
from jobmetrics.sources.jdbc import JdbcTarget
from jobmetrics.sources.tables import TRACKING_COLUMNS, Table


def table_of(settings: list[str]) -> Table:
    options = dict(pair.split("=", 1) for pair in settings)
    return Table(options.pop("format", "parquet"), options)


def parse(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--lake", help="path written by the ingest job")
    source.add_argument("--events", nargs="+", metavar="KEY=VALUE", help="the event table")
    parser.add_argument("--jobs", nargs="+", metavar="KEY=VALUE", required=True)
    parser.add_argument("--store", required=True, help="path of the fact")
    parser.add_argument("--full", action="store_true", help="recompute all days")
    parser.add_argument(
        "--look-back-days", type=float,
        help="with --events: recompute only so many days before the newest event loaded, not "
        "all; later arrivals for older days are left out (a lake knows what arrived)",
    )
    parser.add_argument(
        "--versioned", action="store_true",
        help="keep the fact in versions that are swapped in at once; what the warehouse lacks is published until it has it",
    )
    parser.add_argument("--table", help="name of the fact in the catalog, database.table")
    parser.add_argument("--warehouse", help="JDBC URL to publish the fact to")
    parser.add_argument(
        "--publish", choices=["days", "append", "full"], default="days",
        help="replace the days recomputed, append their rows, or refill the whole table",
    )
    parser.add_argument("--warehouse-table", default="events")
    parser.add_argument("--warehouse-driver", default="com.mysql.cj.jdbc.Driver")
    args = parser.parse_args(argv)
    if args.versioned and (args.table or args.publish == "append" or args.look_back_days is not None or args.full and args.events):
        parser.error("--versioned goes with --lake, --full, --events and --publish days or full only")
    return args


def target_of(args: argparse.Namespace) -> JdbcTarget:
    # The password stays out of the process list.
    return JdbcTarget(
        args.warehouse,
        args.warehouse_driver,
        os.environ.get("WAREHOUSE_USER", ""),
        os.environ.get("WAREHOUSE_PASSWORD", ""),
    )


def load_versioned(spark: SparkSession, args: argparse.Namespace) -> bool:
    """Load into versions; then publish what the warehouse lacks, also of loads whose publishing failed."""
    store = VersionedStore(args.store)
    jobs = job_dimension(table_of(args.jobs).load(spark))
    if args.lake:
        size_shuffles(spark, bytes_in(spark, args.lake))
        days = versioned.load_from_lake(spark, args.lake, jobs, store, args.full)
    else:
        days = versioned.load_from_files(spark, table_of(args.events), jobs, store)
    if args.warehouse:
        target, table = target_of(args), args.warehouse_table

        def write(fact: DataFrame, owed: list[date], whole: bool) -> None:
            if whole or args.publish == "full":
                replace_fact_jdbc(fact, target, table)
            else:
                publish_days(fact, target, owed, table)

        versions.publish(spark, store, f"{table}-{hashlib.sha256(args.warehouse.encode()).hexdigest()[:12]}",
                         versioned.FACTS, schemas.FACT, write)
    return days is not None


def publish(spark: SparkSession, store: incremental.FactStore, args: argparse.Namespace) -> None:
    """Bring the warehouse up to date with what the last load recomputed."""
    target = target_of(args)
    fact, days = read_fact(spark, store.facts), incremental.days_of_last_load(spark, store)
    if args.publish == "full" or days is None:
        replace_fact_jdbc(fact, target, args.warehouse_table)
    elif args.publish == "append":
        write_fact_jdbc(fact.filter(F.col("dates").isin(days)), target, args.warehouse_table)
    else:
        publish_days(fact, target, days, args.warehouse_table)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> bool:
    """True when something was loaded."""
    args = parse(argv)
    spark = spark or build_session("load-fact")
    if args.versioned:
        loaded = load_versioned(spark, args)
        print("loaded new events" if loaded else "no new events")
        return loaded
    store = incremental.FactStore(args.store)
    jobs = job_dimension(table_of(args.jobs).load(spark))
    if args.lake:
        size_shuffles(spark, bytes_in(spark, args.lake))
        loaded = incremental.load_from_lake(spark, args.lake, jobs, store, args.full)
    else:
        events = table_of(args.events).load(spark, TRACKING_COLUMNS)
        if args.full:
            loaded = incremental.full_refresh(events, jobs, store)
        else:
            days = args.look_back_days
            look_back = None if days is None else timedelta(days=days)
            loaded = incremental.incremental_load(events, jobs, store, look_back)
    if loaded and args.table:
        ensure_fact(spark, args.table, store.facts)
    if loaded and args.warehouse:
        publish(spark, store, args)
    print("loaded new events" if loaded else "no new events")
    return loaded


if __name__ == "__main__":
    main()
