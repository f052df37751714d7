"""What several operators of this folder share: sessions, folds, scratch tables, id order."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobmetrics.session import prepare, scratch_path

ROOT = str(Path(__file__).resolve().parents[2])
LOWEST = -(1 << 63)
# Rows and bytes of one Arrow batch, so that long texts come alone. A single row may be larger.
ROWS_PER_BATCH = 1000
BYTES_PER_BATCH = 4 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """The library's session settings, and Arrow batches of bounded rows and bytes.

    Python workers on this machine find the library where the driver has it; to a cluster it
    goes with ``--py-files`` or the workers' PYTHONPATH.
    """
    prepare(spark)
    context = spark.sparkContext
    if context.master.startswith("local"):
        paths = context.environment.get("PYTHONPATH", "").split(":")
        if ROOT not in paths:
            context.environment["PYTHONPATH"] = ":".join(filter(None, [ROOT, *paths]))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ROWS_PER_BATCH:
        spark.conf.set(key, str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    return spark


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def held_out(column: str, folds: int, fold_no: int) -> Column:
    """Whether a row is kept from learning; a row without an id is not held out."""
    return F.coalesce(fold(column, folds) == fold_no, F.lit(False))


def bounded_sample(df: DataFrame, rows: int, by: str = "doc_id") -> DataFrame:
    """At most ``rows`` rows, the same ones whatever the partitioning: the lowest hashes of ``by``.

    Of a large table only those hashes are sorted that can be among the lowest, so that what
    tasks send does not grow with their number. Rows are counted first.
    """
    order = F.xxhash64(F.col(by).cast("string"))
    return df.where(may_be_sampled(order, F.lit(df.count()), rows)).orderBy(order, F.col(by)).limit(rows)


def may_be_sampled(hashed: Column, total: Column, rows: int) -> Column:
    """True for a few times ``rows`` of ``total`` rows, those with the lowest hashes."""
    return (hashed / F.lit(2.0 ** 64) + 0.5) * total <= 3 * rows + 100


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_bounds(df: DataFrame, column: str, parts: int) -> list[int]:
    """First ids of about ``parts`` ranges with equally many rows; a null id counts as lowest.

    Only ``parts`` numbers reach the driver, whatever the size of the table.
    """
    key = F.coalesce(F.col(column), F.lit(LOWEST))
    steps = [i / parts for i in range(parts)]
    cuts = df.agg(F.percentile_approx(key, steps, max(10_000, 20 * parts)).alias("cuts")).first()["cuts"]
    if not cuts:
        return []
    # Quantiles go through doubles, so large ids come back rounded: take the first id of each range.
    ranges = df.select(range_of(column, sorted({LOWEST, *cuts})).alias("range"), key.alias("key"))
    return sorted(row["first"] for row in ranges.groupBy("range").agg(F.min("key").alias("first")).collect())


def range_of(column: str, bounds: Sequence[int]) -> Column:
    """Number of the id's range: how many of ``bounds`` are not above it, less one.

    Two steps of about sqrt(n) comparisons each: first the block of bounds, then within it.
    """
    if not bounds:
        return F.lit(0)
    key = F.coalesce(F.col(column), F.lit(LOWEST))
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [list(bounds[i:i + step]) for i in range(0, len(bounds), step)]
    firsts, nested = [b[0] for b in blocks], blocks
    block = F.size(F.filter(long_array(firsts), lambda x: x <= key)) - 1
    inner = F.element_at(long_array(nested), F.greatest(block, F.lit(0)) + 1)
    return F.greatest(block, F.lit(0)) * step + F.size(F.filter(inner, lambda x: x <= key)) - 1


def long_array(values: Sequence) -> Column:
    """A literal array (or array of arrays) of long numbers, which takes one node of the plan."""
    kind = "array<array<bigint>>" if values and isinstance(values[0], list) else "array<bigint>"
    return F.from_json(F.lit(json.dumps(list(values))), kind)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


ARROW_TYPES = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
    "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
}
Batches = Iterator[list[tuple]]


def release() -> None:
    """Give a Python worker's free memory back to the system; it lives on from task to task."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def map_rows(df: DataFrame, function: Callable[[Batches], Iterable[list[tuple]]], ddl: str) -> DataFrame:
    """``mapInArrow`` with lists of tuples in and out, so that nulls and large ids stay exact.

    Spark uses a Python worker for many tasks; after each one, it gives free memory back to the system.
    """
    fields = [f.split() for f in ddl.split(", ")]
    schema = pa.schema([(name, ARROW_TYPES[kind]) for name, kind in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for rows in function(list(zip(*[c.to_pylist() for c in b.columns])) for b in batches):
                if rows:
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)
        finally:
            release()

    return df.mapInArrow(run, ddl)


def block_pairs(rows: DataFrame, sizes: DataFrame, by: list[str], node: str, block: int) -> DataFrame:
    """Deals groups of rows to tasks so that every two rows of a group meet in one of them.

    A group of more than ``block`` rows is cut into blocks by a hash of ``node``, and each two of
    its blocks become a group of their own, named by the columns ``low`` and ``high``; ``block``
    is the row's own. ``sizes`` has one row for each group: ``by`` and its ``count``.
    """
    large = sizes.where(F.col("count") > block).select(*by, F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = (rows.join(large, by, "left").withColumn("block", F.pmod(F.xxhash64(node), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
             .drop("blocks", "other"))
    group = [*by, "low", "high"]
    return dealt.repartition(*group).sortWithinPartitions(*group, node)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def crc(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
