"""Time-based (version 1) UUIDs as column expressions.

A version 1 UUID carries a 60-bit count of 100 ns steps since 1582-10-15:
``low(8 hex)-mid(4)-1high(4)-variant+clock(4)-node(12)``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values (RFC 9562): microseconds from 1582-10-15 to 1970-01-01, and the text form.
EPOCH_OFFSET_MICROS = 12219292800000000
V1_FORM = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-1[0-9a-fA-F]{3}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\\z"


def is_time_uuid(value: Column) -> Column:
    """True for a version 1 UUID in its text form, false otherwise, also for NULL."""
    return F.coalesce(value.rlike(V1_FORM), F.lit(False))


def time_of(time_uuid: Column) -> Column:
    """Event time, to the microsecond, of a value already known to be a version 1 UUID."""
    steps = F.concat(
        F.substring(time_uuid, 16, 3), F.substring(time_uuid, 10, 4), F.substring(time_uuid, 1, 8)
    )
    # Ten steps per microsecond. Dividing before the epoch shift rounds down on both sides
    # of 1970, because the raw count is never negative.
    micros = F.call_function("div", F.conv(steps, 16, 10).cast("long"), F.lit(10))
    return F.timestamp_micros(micros - EPOCH_OFFSET_MICROS)


def uuid_to_ts(value: Column) -> Column:
    """Event time of a version 1 UUID; NULL for anything else."""
    return F.when(is_time_uuid(value), time_of(value))


def ts_to_uuid(ts: Column, node: Column) -> Column:
    """A version 1 UUID for an event time; ``node`` (a long) tells equal times apart."""
    steps = (F.unix_micros(ts) + EPOCH_OFFSET_MICROS) * 10
    digits = F.lpad(F.lower(F.hex(steps)), 16, "0")
    return F.concat(
        F.substring(digits, 9, 8),
        F.lit("-"),
        F.substring(digits, 5, 4),
        F.lit("-1"),
        F.substring(digits, 2, 3),
        F.lit("-8000-"),
        F.lpad(F.lower(F.hex(node)), 12, "0"),
    )
