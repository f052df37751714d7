"""First copy of each event on a stream.

What a key's first copy is, is looked up in what earlier batches stored of the same days. So
there is no state that grows, and no watermark behind which rows are lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from jobmetrics.operators.upsert import KEY, ORDER
from jobmetrics.streaming.batch_log import ONCE, read_log, start_log


def first_by_key(rows: DataFrame) -> DataFrame:
    """The copy of each key received first.

    Like ``latest_by_key`` it is planned with a limit per key before the shuffle, so a key with
    very many copies sends one per task.
    """
    oldest = Window.partitionBy(KEY).orderBy(*[F.col(c).asc_nulls_last() for c in ORDER])
    ranked = rows.withColumn("_rank", F.row_number().over(oldest))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def start_first_copies(
    events: DataFrame, path: str, layout: str, trigger: dict = ONCE
) -> StreamingQuery:
    """Store the first copy of each ``create_time``; ``layout`` has the columns to keep.

    Events need their day (``dates``), which follows from the key, and the place in the topic.
    """
    columns = [part.split()[0] for part in layout.split(",")]

    def new(batch: DataFrame, batch_id: int) -> DataFrame:
        first = first_by_key(batch)
        # One row per day there is; see PLAUSIBLE in streaming.decode.
        days = [row["dates"] for row in batch.select("dates").distinct().collect()]
        known = read_log(batch.sparkSession, path, layout, upto=batch_id - 1)
        known = known.filter(F.col("dates").isin(days)).select("dates", KEY)
        return first.join(known, ["dates", KEY], "left_anti").select(*columns)

    return start_log(events, path, ["dates"], trigger, prepare=new)


def read_first_copies(spark, path: str, layout: str) -> DataFrame:
    return read_log(spark, path, layout).drop("batch")
