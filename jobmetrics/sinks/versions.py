"""Tables by day of which each load writes new versions of the days it changes.

``<table>/version=<n>/dates=<day>`` is written once and never changed. The index, one row per day, says which version
of a day counts; a day that lost all rows stays in it with none. A load writes its days, then what it
knows about itself, and last the index of its version. That index is the step that counts: until it is complete
readers find the version before, and a load that died leaves nothing but folders that the next one overwrites.
A frame that was read keeps its versions, whatever is loaded meanwhile; they are removed by the load after the next one.

The same index tells what a copy elsewhere lacks: the days whose version is later than the one that was copied last.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmetrics.sinks.files import names_in, remove

_INDEX = "dates DATE, version BIGINT, rows BIGINT"
_LOAD = "version BIGINT, loaded_batch BIGINT, loaded_at TIMESTAMP"
# Tables that are written whole with each version, not by day.
_WHOLE = ["loads", "files", "index"]


@dataclass(frozen=True)
class VersionedStore:
    """Tables that are loaded together: each load has one version for all of them."""

    path: str

    def folder(self, table: str, version: int | None = None) -> str:
        base = f"{self.path}/{table}"
        return base if version is None else f"{base}/version={version}"


def _complete(spark: SparkSession, folder: str) -> list[int]:
    """Versions with a success mark, in ascending order."""
    found = [int(n.partition("=")[2]) for n in names_in(spark, folder) if n.startswith("version=")]
    return sorted(n for n in found if "_SUCCESS" in names_in(spark, f"{folder}/version={n}"))


def current(spark: SparkSession, store: VersionedStore) -> int | None:
    """The version that counts, None before the first load."""
    return max(_complete(spark, store.folder("index")), default=None)


def index(spark: SparkSession, store: VersionedStore, version: int | None = None) -> DataFrame:
    """Day, version and number of rows (0 for a day that lost them all)."""
    version = current(spark, store) if version is None else version
    if version is None:
        return spark.createDataFrame([], _INDEX)
    return spark.read.schema(_INDEX).parquet(store.folder("index", version))


def read(spark: SparkSession, store: VersionedStore, table: str, layout: str,
         days: Collection[date] | None = None) -> DataFrame:
    """The rows that count, of all days or of some; no other day's files are listed."""
    wanted = index(spark, store).filter("rows > 0")
    if days is not None:
        wanted = wanted.filter(F.col("dates").isin(list(days)))
    # One row per day there is.
    folders = [store.folder(table, r["version"]) + f"/dates={r['dates']}" for r in wanted.collect()]
    if not folders:
        return spark.createDataFrame([], layout)
    rows = spark.read.schema(f"{layout}, version BIGINT").option("basePath", store.folder(table)).parquet(*folders)
    return rows.drop("version")


def stage(rows: DataFrame, store: VersionedStore, table: str, version: int) -> None:
    """Write rows of a version that does not count yet."""
    rows.hint("rebalance", "dates").write.mode("overwrite").partitionBy("dates").parquet(store.folder(table, version))


def commit(spark: SparkSession, store: VersionedStore, version: int, changed: DataFrame, batch: int | None = None) -> None:
    """Let a version count. ``changed`` has a day and its number of rows each; ``batch`` is the last one of the source."""
    known = spark.range(1).select(F.lit(version).cast("long").alias("version"), F.lit(batch).cast("long").alias("loaded_batch"),
                                  F.current_timestamp().alias("loaded_at"))
    known.coalesce(1).write.mode("overwrite").parquet(store.folder("loads", version))
    days = changed.select("dates", F.lit(version).cast("long").alias("version"), F.col("rows").cast("long").alias("rows"))
    kept = index(spark, store).join(F.broadcast(days.select("dates")), "dates", "left_anti")
    kept.unionByName(days).coalesce(1).write.mode("overwrite").parquet(store.folder("index", version))
    _sweep(spark, store)


def following(spark: SparkSession, store: VersionedStore) -> int:
    """The number of the next version."""
    version = current(spark, store)
    return 0 if version is None else version + 1


def last_load(spark: SparkSession, store: VersionedStore):
    """What the load of the current version knew, None before the first."""
    version = current(spark, store)
    return None if version is None else spark.read.schema(_LOAD).parquet(store.folder("loads", version)).first()


def _sweep(spark: SparkSession, store: VersionedStore) -> None:
    """Remove days that neither the current index nor the one before names."""
    done = _complete(spark, store.folder("index"))
    kept = {(r["version"], r["dates"]) for n in done[-2:] for r in index(spark, store, n).filter("rows > 0").collect()}
    for table in names_in(spark, store.path):
        if table in _WHOLE or table == "published":
            continue
        for name in names_in(spark, store.folder(table)):
            version = int(name.partition("=")[2]) if name.startswith("version=") else None
            if version is None or version > done[-1]:
                continue
            folder = store.folder(table, version)
            days = [d for d in names_in(spark, folder) if d.startswith("dates=")]
            gone = [d for d in days if (version, date.fromisoformat(d.partition("=")[2])) not in kept]
            for day in gone:
                remove(spark, f"{folder}/{day}")
            if len(gone) == len(days):
                remove(spark, folder)
    for n in done[:-2]:
        for table in _WHOLE:
            remove(spark, store.folder(table, n))


def published(spark: SparkSession, store: VersionedStore, target: str) -> int | None:
    """The version that a target was last brought up to, None if never."""
    return max(_complete(spark, store.folder(f"published/{target}")), default=None)


def owed(spark: SparkSession, store: VersionedStore, target: str) -> list[date]:
    """Days that a target lacks, emptied ones included."""
    upto = published(spark, store, target)
    found = index(spark, store)
    found = found if upto is None else found.filter(F.col("version") > upto)
    return sorted(r["dates"] for r in found.select("dates").collect())


def publish(spark: SparkSession, store: VersionedStore, target: str, table: str, layout: str,
            write: Callable[[DataFrame, list[date], bool], None]) -> list[date]:
    """Bring a target up to date with ``write(rows of the table, days owed, whether it has nothing yet)``.

    What it owes is cleared only after the write: if that fails, the next call owes it all again, with whatever
    came meanwhile. Returns the days written.
    """
    version, days = current(spark, store), owed(spark, store, target)
    if version is None or not days:
        return []
    write(read(spark, store, table, layout), days, published(spark, store, target) is None)
    mark = spark.range(1).select(F.current_timestamp().alias("published_at"))
    mark.coalesce(1).write.mode("overwrite").parquet(store.folder(f"published/{target}", version))
    for older in _complete(spark, store.folder(f"published/{target}"))[:-1]:
        remove(spark, store.folder(f"published/{target}", older))
    return days
