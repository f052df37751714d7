"""A table written one micro-batch at a time, and compacted by day.

Each batch owns the directory ``log/batch=<id>`` and overwrites it, so a batch that is replayed
after a failure replaces its own first attempt. A finished batch is marked as done, which
lets readers leave out the one being written. The checkpoint lives inside the table's folder:
whoever starts over with a new checkpoint starts a new table too, and batch numbers of two
runs never meet.

Compaction gathers the batches since the last one, day by day, into ``base/upto=<id>``, together
with what the base had of these days. The index, one row per day, says which version of a day
counts; days that got nothing new stay where they are. Readers list the index, the versions it
names and the batches after it, however many batches there have been. What a compaction
replaces is removed by the next but one, so that readers of the version before can finish.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from jobmetrics.sinks.files import names_in, remove
from jobmetrics.sources.tables import read_if_present

ONCE = {"availableNow": True}
_INDEX = "dates DATE, upto BIGINT"
# What Spark names the folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

Prepare = Callable[[DataFrame, int], DataFrame]


def start_log(
    stream: DataFrame,
    path: str,
    partitions: list[str],
    trigger: dict,
    prepare: Prepare | None = None,
    then: Callable[[SparkSession, int], None] | None = None,
) -> StreamingQuery:
    """``prepare`` makes a batch's rows from what arrived; ``then`` runs once they are stored.

    Both may run again for the same batch after a failure.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch, batch_id) if prepare else batch
        # Gathers each partition into few files but splits one too big for a task.
        rows.hint("rebalance", *partitions).write.mode("overwrite").partitionBy(*partitions).parquet(
            f"{path}/log/batch={batch_id}"
        )
        mark = batch.sparkSession.range(1).select(F.current_timestamp().alias("done_at"))
        mark.coalesce(1).write.mode("overwrite").parquet(f"{path}/done/batch={batch_id}")
        if then:
            then(batch.sparkSession, batch_id)

    return (
        stream.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(**trigger)
        .start()
    )


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    found = names_in(spark, path)
    return sorted(int(n.partition("=")[2]) for n in found if n.startswith(f"{name}="))


def compacted_upto(spark: SparkSession, path: str) -> int:
    """Last batch of the last compaction, -1 without one."""
    # A folder without its success mark is of a compaction that died.
    return max((n for n in _numbers(spark, f"{path}/index", "upto")
                if "_SUCCESS" in names_in(spark, f"{path}/index/upto={n}")), default=-1)


def last_batch(spark: SparkSession, path: str) -> int | None:
    """Number of the last batch that is done; all before it are done too."""
    done = [n for n in _numbers(spark, f"{path}/done", "batch")
            if "_SUCCESS" in names_in(spark, f"{path}/done/batch={n}")]
    last = max([*done, compacted_upto(spark, path)])
    return None if last < 0 else last


def _index(spark: SparkSession, path: str, upto: int) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(f"{path}/index/upto={upto}")


def _base(spark: SparkSession, path: str, schema: str, upto: int, after: int = -1) -> DataFrame:
    """What the index names, of versions later than ``after``."""
    index = _index(spark, path, upto).filter(F.col("upto") > after)
    versions = [row["upto"] for row in index.select("upto").distinct().collect()]
    if not versions:
        return spark.createDataFrame([], f"{schema}, batch BIGINT")
    stored = spark.read.schema(f"{schema}, batch BIGINT, upto BIGINT").option(
        "basePath", f"{path}/base").parquet(*[f"{path}/base/upto={n}" for n in versions])
    # One row per day there is; see PLAUSIBLE in streaming.decode.
    return _where_in(stored, F.broadcast(index), ["dates", "upto"]).select(*_names(schema), "batch")


def _where_in(rows: DataFrame, keys: DataFrame, columns: list[str], how: str = "left_semi") -> DataFrame:
    """Rows whose values are, or with ``left_anti`` are not, among ``keys``. Rejected rows have no
    day, so nulls are equal here."""
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}")) for c in columns]
    return rows.alias("r").join(keys.alias("k"), same, how)


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(",")]


def read_log(spark: SparkSession, path: str, schema: str, upto: int | None = None,
             after: int = -1) -> DataFrame:
    """Rows of the batches that are done, with the number of their ``batch``.

    ``upto`` leaves out later batches, unless they are compacted; ``after`` leaves out those up
    to it. ``schema`` must have a column ``dates``.
    """
    base = compacted_upto(spark, path)
    last = last_batch(spark, path)
    last = -1 if last is None else last
    last = last if upto is None else max(base, min(upto, last))
    folders = [f"{path}/log/batch={n}" for n in range(max(base, after) + 1, last + 1)]
    layout = f"{schema}, batch BIGINT"
    rows = spark.createDataFrame([], layout)
    if folders:
        rows = spark.read.schema(layout).option("basePath", f"{path}/log").parquet(*folders)
    if base > after:
        older = _base(spark, path, schema, base, after)
        rows = (rows.unionByName(older) if folders else older).filter(F.col("batch") > after)
    return rows


def compact(spark: SparkSession, path: str, schema: str, partitions: list[str],
            resolve: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> bool:
    """Gather the batches since the last compaction; False if there are none.

    ``resolve`` may drop versions of rows that no reader needs. Only one may run at a time.
    """
    last, base = last_batch(spark, path), compacted_upto(spark, path)
    if last is None or last <= base:
        return False
    fresh = read_log(spark, path, schema, after=base)
    days = fresh.select("dates").distinct()
    index = _index(spark, path, base) if base >= 0 else spark.createDataFrame([], _INDEX)
    rows = fresh
    if base >= 0:
        rows = _where_in(_base(spark, path, schema, base), F.broadcast(days), ["dates"]).unionByName(fresh)
    by = list(dict.fromkeys([*partitions, "dates"]))
    resolve(rows).hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(
        f"{path}/base/upto={last}")
    kept = _where_in(index, F.broadcast(days), ["dates"], "left_anti")
    now = kept.unionByName(days.select("dates", F.lit(last).cast("long").alias("upto")))
    now.coalesce(1).write.mode("overwrite").parquet(f"{path}/index/upto={last}")
    _sweep(spark, path, base)
    return True


def _sweep(spark: SparkSession, path: str, kept: int) -> None:
    """Remove what the compaction before the last one, ``kept``, has replaced."""
    if kept < 0:
        return
    for folder in ("log", "done"):
        for n in _numbers(spark, f"{path}/{folder}", "batch"):
            if n <= kept:
                remove(spark, f"{path}/{folder}/batch={n}")
    older = [n for n in _numbers(spark, f"{path}/index", "upto") if n < kept]
    for n in older:
        gone = _where_in(_index(spark, path, n), _index(spark, path, kept), ["dates", "upto"], "left_anti")
        for row in gone.collect():
            version, day = f"{path}/base/upto={row['upto']}", f"dates={row['dates'] or NO_DAY}"
            for name in names_in(spark, version):
                remove(spark, f"{version}/{name}/{day}")
            remove(spark, f"{version}/{day}")
        remove(spark, f"{path}/index/upto={n}")
