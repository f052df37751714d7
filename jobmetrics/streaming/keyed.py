"""Streams that remember each key in Spark's state store, so that a batch costs what it brings.

``hourly cells from changes``: of each key the state holds the version that counts. A later version takes the
earlier one back and adds itself, so each batch gives changes of cells, summed up within the batch and stored. The cells
are the sums of the changes, the same however the input is cut into batches, with copies, resends and late events.
Nothing of earlier batches is read. ``first copies`` are found the same way.

The keys of an hour lie in a fixed number of groups, each one row of the state store, so Python is called once a group and
batch, not once a key. State is kept for ever, or, for rows that went through ``streaming.gate``, until its hour is closed: the
gate lets no row of a closed hour pass, and its clock is the watermark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from jobmetrics.functions.time_uuid import uuid_to_ts
from jobmetrics.functions.values import null_if_zero
from jobmetrics.operators.clean import EVENT_TYPES, ID_COLUMNS
from jobmetrics.operators.metrics import CELL
from jobmetrics.operators.upsert import KEY
from jobmetrics.streaming import batch_log
from jobmetrics.streaming.batch_log import ONCE, read_log, start_log

# What a version is ordered by, and what it counts for.
_ORDER = ["received", "offset", "partition"]
_VERSION = ("received long, offset long, partition int, closes long, counts boolean, job_id double, publisher_id double, "
            "campaign_id double, group_id double, day int, hour int, kind string, bid double")
_NAMES = [part.split()[0] for part in _VERSION.split(", ")]
_CHANGE = f"sign int, {_VERSION.partition('counts boolean, ')[2]}"
_PAYLOAD = [part.split()[0] for part in _CHANGE.split(", ")][1:]
_SUMS = ["clicks", "spend", "conversions", "qualified", "unqualified"]
_LAYOUT = """
    job_id DOUBLE, hour INT, publisher_id DOUBLE, campaign_id DOUBLE, group_id DOUBLE, clicks BIGINT,
    spend DOUBLE, conversions BIGINT, qualified BIGINT, unqualified BIGINT, dates DATE
"""
CLOCK = "clock"
# Groups that the keys of an hour are dealt to: what one call of Python handles, and what a batch with any of its keys rewrites.
PARTS_OF_HOUR = 16
# The gate's clock stands still within a batch of the gate; nothing may be behind it by as much as this.
_BEHIND = "1 millisecond"


def _place() -> dict[str, Column]:
    """Where a message stands in the topic, and when the hour of its event is over."""
    hour_end = F.date_trunc("hour", "event_time") + F.expr("INTERVAL 1 HOUR")
    return {
        "received": F.coalesce(F.unix_micros("received_at"), F.lit(0)), "offset": F.coalesce(F.col("offset"), F.lit(0)),
        "partition": F.coalesce(F.col("partition"), F.lit(0)), "closes": F.unix_millis(hour_end),
    }


def timed(events: DataFrame) -> DataFrame:
    """With the ``event_time`` that the key holds, unless it is there."""
    return events if "event_time" in events.columns else events.withColumn("event_time", uuid_to_ts(F.col(KEY)))


def versions(events: DataFrame) -> DataFrame:
    """What each accepted message of an event says, without nulls; see ``clean.tracking_clean``."""
    at = F.col("event_time")
    known = F.coalesce(F.col("custom_track").isin(EVENT_TYPES), F.lit(False))
    ids = {name: F.coalesce(F.nanvl(F.col(name), F.lit(0.0)), F.lit(0.0)) for name in ID_COLUMNS}
    bid = F.coalesce(F.nanvl(F.col("bid"), F.lit(0.0)), F.lit(0.0))
    columns = {
        **_place(), "counts": F.col("job_id").isNotNull() & known, **ids, "day": F.unix_date(F.to_date(at)), "hour": F.hour(at),
        "kind": F.coalesce(F.col("custom_track"), F.lit("")), "bid": F.when(F.col("custom_track") == "click", bid).otherwise(0.0),
    }
    kept = [c for c in (KEY, CLOCK) if c in events.columns]
    return timed(events).select(*kept, *[columns[name].alias(name) for name in _NAMES])


def _best(frames: Iterable[pd.DataFrame], last: bool) -> pd.DataFrame:
    """The last, or first, row of each key by the place in the topic; a frame holds some rows of a hot key or hour."""
    best = None
    for frame in frames:
        rows = frame if best is None else pd.concat([best, frame], ignore_index=True)
        keys, _ = pd.factorize(rows[KEY], use_na_sentinel=False)
        order = np.lexsort([*(rows[c].to_numpy() for c in reversed(_ORDER)), keys])
        changed = keys[order][1:] != keys[order][:-1]
        best = rows.iloc[np.sort(order[np.r_[changed, True] if last else np.r_[True, changed]])]
    return best


def _later(rows: pd.DataFrame, others: pd.DataFrame) -> np.ndarray:
    """Which rows come after those beside them in the topic."""
    later, level = np.zeros(len(rows), bool), np.ones(len(rows), bool)
    for name in _ORDER:
        one, other = rows[name].to_numpy(), others[name].to_numpy()
        later |= level & (one > other)
        level &= one == other
    return later


def _packed(rows: pd.DataFrame) -> bytes:
    table, sink = pa.Table.from_pandas(rows, preserve_index=False).replace_schema_metadata(None), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(state: GroupState) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(state.get[0])).read_all().to_pandas()


def _changes(group: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    came = _best(frames, last=True)[[KEY, *_NAMES]]
    before = _unpacked(state) if state.exists else came.iloc[:0]
    at = pd.Index(before[KEY]).get_indexer(came[KEY])
    counting = at < 0
    counting[~counting] = _later(came[~counting], before.iloc[at[~counting]])
    came, at = came[counting], at[counting]
    if came.empty:
        return
    kept = np.ones(len(before), bool)
    kept[at[at >= 0]] = False
    state.update((_packed(pd.concat([before[kept], came], ignore_index=True)),))
    # What a key counted for so far, and counts for now.
    old = before.iloc[at] if len(before) else came
    was, now = (at >= 0) & old["counts"].to_numpy(bool), came["counts"].to_numpy(bool)
    differs = ~(was & now)
    for name in _PAYLOAD:
        differs |= old[name].to_numpy() != came[name].to_numpy()
    changed = [rows[_PAYLOAD].assign(sign=np.int32(sign)) for sign, rows in ((-1, old[was & differs]), (1, came[now & differs]))]
    yield pd.concat(changed, ignore_index=True)[["sign", *_PAYLOAD]]


def _closing(function):
    """The same, with the state of a group given up when its hour is closed."""

    def run(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        yield from function(group, frames, state)
        # Rows of one group are of one hour, so they close together.
        state.setTimeoutTimestamp(int(group[0]))

    return run


def _stateful(rows: DataFrame, function, output: str) -> DataFrame:
    closing = CLOCK in rows.columns
    if closing:
        rows = rows.withWatermark(CLOCK, _BEHIND)
    timeout = GroupStateTimeout.EventTimeTimeout if closing else GroupStateTimeout.NoTimeout
    # A key names its time, so all its rows are of one hour and in one group.
    grouped = rows.withColumn("part", F.pmod(F.xxhash64(KEY), F.lit(PARTS_OF_HOUR))).groupBy("closes", "part")
    return grouped.applyInPandasWithState(
        _closing(function) if closing else function, output, "known binary", "append", timeout)


def changes(events: DataFrame) -> DataFrame:
    """Rows to add to cells (``sign`` 1) or take back (-1) for the events that came, given those that came before."""
    return _stateful(versions(events), _changes, _CHANGE)


def partial_cells(changed: DataFrame) -> DataFrame:
    """Changes summed up by cell; a cell whose sums stay the same is left out."""
    def count(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("sign")).otherwise(0))

    cells = changed.withColumn("dates", F.date_from_unix_date("day")).groupBy(*_cell()).agg(
        count("click").alias("clicks"), F.sum(F.col("sign") * F.col("bid")).alias("spend"),
        count("conversion").alias("conversions"), count("qualified").alias("qualified"),
        count("unqualified").alias("unqualified"))
    return cells.filter(" OR ".join(f"{c} <> 0" for c in _SUMS)).select(*_columns())


def _cell() -> list[str]:
    return ["dates" if name == "date" else name for name in CELL]


def _columns() -> list[str]:
    return [part.split()[0] for part in _LAYOUT.split(",")]


def summed(partial: DataFrame) -> DataFrame:
    return partial.groupBy(*_cell()).agg(*[F.sum(c).alias(c) for c in _SUMS], F.max("batch").alias("batch"))


def start_hourly_changes(events: DataFrame, path: str, trigger: dict = ONCE, compact_every: int = 0) -> StreamingQuery:
    """Keep hourly cells under ``path`` up to date from accepted, decoded messages."""

    def after(spark: SparkSession, batch_id: int) -> None:
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact(spark, path)

    return start_log(changes(events), path, ["dates"], trigger, prepare=lambda batch, _: partial_cells(batch), then=after)


def compact(spark: SparkSession, path: str) -> bool:
    """Gather the changes since the last time, by day, into one row a cell."""
    return batch_log.compact(spark, path, _LAYOUT, ["dates"], lambda rows: summed(rows).select(*_columns(), "batch"))


def read_hourly_changes(spark: SparkSession, path: str) -> DataFrame:
    """The cells: the same columns and values as ``metrics.hourly_metrics`` of all that came.

    Amounts that were taken back leave a rounding error of the size that sums of doubles have anyway.
    """
    totals = summed(read_log(spark, path, _LAYOUT)).withColumnRenamed("dates", "date")
    counts = [c for c in _SUMS if c != "spend"]
    any_event = " OR ".join(f"{c} > 0" for c in counts)
    clicks = null_if_zero(F.col("clicks"))
    return totals.filter(any_event).select(
        *CELL, (F.col("spend") / clicks).alias("bid_set"), clicks.alias("clicks"),
        F.when(F.col("clicks") > 0, F.col("spend")).alias("spend_hour"),
        *[null_if_zero(F.col(c)).alias(c) for c in counts if c != "clicks"])


def first_copies(events: DataFrame, layout: str) -> DataFrame:
    """The first copy of each key that came, whole; ``layout`` has the columns to keep.

    Of copies in one batch the first in the topic. Values travel as JSON, so that nulls and types stay what they are.
    """
    names = [part.split()[0] for part in layout.split(",")]
    whole = F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("whole")
    rows = timed(events).select(*[c for c in (KEY, CLOCK) if c in events.columns], whole,
                         *[c.alias(n) for n, c in _place().items()])
    found = _stateful(rows, _first, "whole string")
    return found.select(F.from_json("whole", layout).alias("row")).select("row.*")


def _first(group: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    came = _best(frames, last=False)[[KEY, "whole"]]
    if state.exists:
        before = _unpacked(state)
        came = came[~came[KEY].isin(before[KEY]).to_numpy()]
        if came.empty:
            return
        known = pd.concat([before, came[[KEY]]], ignore_index=True)
    else:
        known = came[[KEY]]
    state.update((_packed(known),))
    yield came[["whole"]].reset_index(drop=True)


def start_first_copies(events: DataFrame, path: str, layout: str, trigger: dict = ONCE) -> StreamingQuery:
    """Store the first copy of each ``create_time``; ``layout`` must have ``dates``."""
    return start_log(first_copies(events, layout), path, ["dates"], trigger)


def read_first_copies(spark: SparkSession, path: str, layout: str) -> DataFrame:
    return read_log(spark, path, layout).drop("batch")
