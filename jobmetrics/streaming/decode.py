"""JSON messages to typed rows, with a reason for each message that cannot be used.

Nothing is raised: one bad message must not stop the stream. All fields are read as text
first, because reading a number written in quotes straight as DOUBLE would give NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from jobmetrics.functions.time_uuid import is_time_uuid, uuid_to_ts
from jobmetrics.functions.values import text_to_double
from jobmetrics.schemas import MESSAGE_FIELDS, MESSAGE_NUMBERS

# Where and when the topic took a message in.
POSITION = ["received_at", "offset", "partition"]
_CORRUPT = "_corrupt"
# A key may name any time from 1582 to 5236. Outside these bounds it is no event time, and
# would make tables by day as wide as a clock can be wrong.
PLAUSIBLE = "event_time >= TIMESTAMP '1990-01-01' AND event_time <= received_at + INTERVAL 1 DAY"


def decode_messages(messages: DataFrame) -> DataFrame:
    """``value``, ``received_at``, ``offset`` and ``partition`` to the message fields plus

    ``reject_reason`` (``malformed_json``, ``not_numeric``, ``bad_create_time``,
    ``implausible_time``, NULL for a good message), ``raw`` (the text of a rejected message) and ``dates`` (the day of a good one).
    """
    layout = ", ".join(f"{name} STRING" for name in [*MESSAGE_FIELDS, _CORRUPT])
    message = F.from_json("_text", layout, {"columnNameOfCorruptRecord": _CORRUPT})
    parsed = messages.select(
        *POSITION, F.col("value").cast("string").alias("_text")
    ).withColumn("_m", message)
    # Each step is a projection of its own, so that what it computes is computed once.
    number = {n: text_to_double(F.col(f"_m.{n}")).alias(n) for n in MESSAGE_NUMBERS}
    typed = parsed.select("*", *[number.get(n, F.col(f"_m.{n}")) for n in MESSAGE_FIELDS])
    readable = (
        F.col("_m").isNotNull()
        & F.col(f"_m.{_CORRUPT}").isNull()
        & F.is_valid_utf8("_text")
        # The reader ignores what follows the first object.
        & (F.col("_text").endswith("}") | F.col("_text").rlike(r"\}\s*\z"))
    )
    bad_number = reduce(
        lambda a, b: a | b,
        [F.col(f"_m.{n}").isNotNull() & F.col(n).isNull() for n in MESSAGE_NUMBERS],
    )
    key = F.col("create_time")
    reason = (
        F.when(~F.coalesce(readable, F.lit(False)), "malformed_json")
        .when(bad_number, "not_numeric")
        .when(~is_time_uuid(key), "bad_create_time")
        .when(~F.coalesce(F.expr(PLAUSIBLE), F.lit(True)), "implausible_time")
    )
    timed = typed.withColumn("event_time", uuid_to_ts(key))
    judged = timed.withColumn("reject_reason", reason).select(
        *MESSAGE_FIELDS,
        *POSITION,
        "reject_reason",
        F.when(F.col("reject_reason").isNotNull(), F.col("_text")).alias("raw"),
        F.when(F.col("reject_reason").isNull(), F.to_date("event_time")).alias("dates"),
    )
    # One row per message all the same. The generator keeps later filters above it; they would
    # be moved below a projection and do the parsing a second time.
    return judged.select(F.inline(F.array(F.struct(*judged.columns))))


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw")


def rejected(decoded: DataFrame) -> DataFrame:
    """Dead letters: the reason and the whole text of each rejected message."""
    return decoded.filter(F.col("reject_reason").isNotNull()).select(
        *POSITION, "reject_reason", "raw"
    )
