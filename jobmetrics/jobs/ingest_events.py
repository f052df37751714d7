"""Write event messages from the topic to the event lake, and keep hourly metrics if asked to.

    spark-submit --py-files jobmetrics.zip jobmetrics/jobs/ingest_events.py \\
        --servers kafka:9092 --topic tracking \\
        --lake s3a://bucket/events --hourly s3a://bucket/hourly --every "1 minute"

Further ``--option key=value`` pairs go to the topic source, such as ``startingOffsets=latest``,
``subscribePattern=...`` (without ``--topic``) or ``maxOffsetsPerTrigger=...``.
"""

from __future__ import annotations

import argparse

from jobmetrics.session import build_session
from jobmetrics.sources.topic import read_topic
from jobmetrics.streaming import hourly, ingest
from jobmetrics.streaming.batch_log import ONCE


def parse(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topic")
    parser.add_argument("--lake", required=True)
    parser.add_argument("--hourly", help="path of hourly metrics to keep up to date")
    parser.add_argument("--every", help="batch interval; without it, take what is there and stop")
    parser.add_argument("--compact-every", type=int, default=50, help="batches between compactions")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                        help="option of the topic source")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session("ingest-events")
    options = dict(pair.split("=", 1) for pair in args.option)
    messages = read_topic(spark, args.servers, args.topic, **options)
    trigger = {"processingTime": args.every} if args.every else ONCE
    if args.hourly:
        query = hourly.start_hourly(messages, args.lake, args.hourly, trigger, args.compact_every)
    else:
        query = ingest.start_ingest(messages, args.lake, trigger, args.compact_every)
    query.awaitTermination()


if __name__ == "__main__":
    main()
