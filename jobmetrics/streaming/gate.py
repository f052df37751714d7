"""Closing hours: which events still count, decided once and kept.

The clock of a batch is the newest event time of all batches before it, less a delay. An event whose hour was over by that clock
is late: it is set aside with the reason, the clock and its batch. All others pass, and carry the clock on. So what passes
and what is set aside add up to what was sent, and stateful streams behind the gate can give up what they know of an hour
once the clock has passed it (``streaming.keyed``): they take the clock as their watermark, and nothing that passed is behind it.

Both go to one log, a folder a batch. A batch that is done again replaces itself, with the same clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from jobmetrics import schemas
from jobmetrics.sources.tables import read_if_present
from jobmetrics.streaming.batch_log import ONCE, read_log, start_log
from jobmetrics.streaming.keyed import timed

_LAYOUT = (
    f"{schemas.MESSAGE}, received_at TIMESTAMP, offset BIGINT, partition INT, event_time TIMESTAMP, "
    "clock TIMESTAMP, outcome STRING, dates DATE"
)
PARTITIONS = ["outcome", "dates"]
_MARKS = "newest TIMESTAMP, batch BIGINT"
# The clock before the first event: that of the first plausible one, see streaming.decode.
START = "TIMESTAMP '1990-01-01'"


def clock_before(spark: SparkSession, path: str, batch_id: int, delay: str) -> DataFrame:
    """One row: the ``clock`` of a batch."""
    marks = read_if_present(spark, f"{path}/marks", _MARKS)
    if marks is None:
        return spark.range(1).select(F.expr(START).alias("clock"))
    newest = F.max(F.col("newest")) - F.expr(f"INTERVAL {delay}")
    return marks.filter(F.col("batch") < batch_id).agg(F.coalesce(newest, F.expr(START)).alias("clock"))


def start_gate(events: DataFrame, path: str, delay: str = "2 hours", trigger: dict = ONCE) -> StreamingQuery:
    """Sort accepted, decoded messages into those that count and late ones."""

    def sort_out(batch: DataFrame, batch_id: int) -> DataFrame:
        clock = clock_before(batch.sparkSession, path, batch_id, delay)
        hour_end = F.date_trunc("hour", "event_time") + F.expr("INTERVAL 1 HOUR")
        sorted_out = batch.withColumn("clock", clock.scalar())
        late = hour_end <= F.col("clock")
        return sorted_out.withColumn("outcome", F.when(late, "late").otherwise("open")).select(
            *[part.split()[0] for part in _LAYOUT.split(",")])

    def mark(spark: SparkSession, batch_id: int) -> None:
        rows = spark.read.schema(_LAYOUT).parquet(f"{path}/log/batch={batch_id}")
        # The newest of a batch may be older than those before it; the clock takes the maximum of all.
        rows.agg(F.max("event_time").alias("newest")).write.mode("overwrite").parquet(f"{path}/marks/batch={batch_id}")

    return start_log(timed(events), path, PARTITIONS, trigger, prepare=sort_out, then=mark)


def open_events(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """What passed the gate, as a stream for ``streaming.keyed``; files come in the order of the batches.

    A batch that died half-way and was done again may be seen twice, which keyed state takes for one.
    """
    rows = spark.readStream.schema(f"{_LAYOUT}, batch BIGINT").options(**options).parquet(f"{path}/log")
    return rows.filter(F.col("outcome") == "open").drop("outcome", "batch")


def late_events(spark: SparkSession, path: str) -> DataFrame:
    """What was set aside, with the ``batch`` it came in, the ``clock`` then and the reason."""
    rows = read_log(spark, path, _LAYOUT).filter(F.col("outcome") == "late")
    return rows.withColumn("reason", F.lit("hour closed")).drop("outcome")


def counts(spark: SparkSession, path: str) -> DataFrame:
    """Messages by outcome and day of the event."""
    return read_log(spark, path, _LAYOUT).groupBy("outcome", "dates").agg(F.count("*").alias("messages"))
