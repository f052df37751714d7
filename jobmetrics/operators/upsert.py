"""Keyed upsert, last write wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

KEY = "create_time"
# A topic counts offsets per partition, so two copies may share time and offset.
ORDER = ("received_at", "offset", "partition")


def latest_by_key(
    rows: DataFrame, key: Sequence[str] = (KEY,), order: Sequence[str] = ORDER
) -> DataFrame:
    """The last version of each key, whole: a later NULL replaces an earlier value.

    ``row_number() = 1`` is planned with a limit per key on both sides of the shuffle, so of
    a key with very many copies each task sends one.
    """
    newest = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return (
        rows.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def upsert(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """``existing`` after the inserts and replacements in ``incoming``."""
    return latest_by_key(existing.unionByName(incoming))
