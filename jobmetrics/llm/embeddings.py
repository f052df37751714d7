"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Rotations are learned on a bounded sample so that the signs of the rotated, centred vectors are
balanced binary codes close to the vectors. The bits of the codes are cut into substrings, each
the key of a table, and two vectors meet where a substring is equal. There their cosine is taken
from the original vectors. Tables are as many as a pair at the least similarity needs to meet
with the wanted probability. Equal vectors are one row from the start.

A bucket is compared in blocks, so that a large one is shared by many tasks, and gives no pairs:
only, for each of its vectors, how many others are linked and the least one reached. A pair that
meets in several tables counts in the first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby
from math import acos, ceil, log, log2, pi

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from jobmetrics.llm.common import Batches, block_pairs, bounded_sample, map_rows, stored
from jobmetrics.llm.components import components

COSINE = 0.9
# The rotations are fitted on at most this many vectors.
SAMPLE = 10_000
STEPS = 30
# Of pairs exactly at the least cosine at most this share may never meet, if bits are independent.
MISSED = 0.005
# Vectors that share a key by chance, and the most that one task compares with as many others.
PER_BUCKET, BLOCK = 256, 2048
LEAST_BITS = 8


@dataclass(frozen=True)
class Tables:
    """Rotations for one length of vectors, and how their bits are cut."""

    dimension: int
    mean: np.ndarray
    rotations: np.ndarray
    tables: int
    bits: int

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """A key for each table, of rows of unit vectors."""
        if not self.bits:
            return np.zeros((len(unit), 1), np.int64)
        signs = np.concatenate([(unit - self.mean) @ r > 0 for r in self.rotations], axis=1)
        cut = signs[:, :self.tables * self.bits].reshape(len(unit), self.tables, self.bits)
        return cut @ (1 << np.arange(self.bits, dtype=np.int64))


def layout(n: int, cosine: float = COSINE) -> tuple[int, int]:
    """(tables, bits) for n vectors: buckets stay small, and pairs at the least cosine still meet.

    As many as one bucket may hold are one bucket.
    """
    if n <= PER_BUCKET:
        return 1, 0
    bits = max(LEAST_BITS, ceil(log2(max(n, 1) / PER_BUCKET)))
    equal = (1 - acos(cosine) / pi) ** bits
    return max(1, ceil(log(MISSED) / log(1 - equal))), bits


def rotation(x: np.ndarray, seed: int, steps: int = STEPS) -> np.ndarray:
    """Principal directions times the rotation that brings the signs of ``x`` closest to it."""
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    width = x.shape[1]
    axes = np.concatenate([axes, np.zeros((max(0, width - len(axes)), width))]).T
    v = x @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, width)))
    for _ in range(steps):
        a, _, b = np.linalg.svd(v.T @ np.where(v @ turn > 0, 1.0, -1.0))
        turn = a @ b
    return axes @ turn


def fit(vectors: DataFrame, n: int, dimension: int, cosine: float = COSINE) -> Tables:
    """Rotations from a bounded sample of unit vectors (node, unit as bytes)."""
    rows = bounded_sample(vectors.select("node", "unit"), SAMPLE, "node").collect()
    unit = np.array([np.frombuffer(r["unit"], "<f8") for r in rows]).reshape(-1, dimension)
    tables, bits = layout(n, cosine)
    mean = unit.mean(0) if len(unit) else np.zeros(dimension)
    some = [rotation(unit - mean, seed) for seed in range(ceil(tables * bits / dimension))]
    return Tables(dimension, mean, np.array(some), tables, bits)


def is_usable(column: str) -> Column:
    """Whether an array has a direction: some number but zero, none null, infinite or not a number."""
    x = F.col(column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))


def units(batches: Batches) -> Iterable[list[tuple]]:
    """(node, copies, unit vector as bytes) from (node, copies, numbers)."""
    for rows in batches:
        out = []
        for node, copies, numbers in rows:
            x = np.array(numbers, float)
            x = x / np.abs(x).max()
            out.append((node, copies, (x / np.sqrt(x @ x)).tobytes()))
        yield out


def compare(members: list[tuple], first_block: int, second_block: int, cosine: float,
            dimension: int) -> Iterator[tuple[int, int, int]]:
    """(node, linked vectors, least node reached) within a block, or between two blocks.

    Members are (block, table, node, copies, unit, keys of all tables as bytes).
    """
    unit = np.frombuffer(b"".join(m[4] for m in members), "<f8").reshape(-1, dimension)
    keys = np.frombuffer(b"".join(m[5] for m in members), "<i4").reshape(len(members), -1)
    node, copies = (np.array([m[k] for m in members], np.int64) for k in (2, 3))
    block, table = np.array([m[0] for m in members]), members[0][1]
    near = unit @ unit.T >= cosine
    np.fill_diagonal(near, False)
    if first_block != second_block:
        near &= block[:, None] != block[None, :]
    a, b = np.nonzero(near)
    if not len(a):
        return
    counts_here = (keys[a] == keys[b]).argmax(1) == table
    links = np.bincount(a[counts_here], copies[b[counts_here]], len(members)).astype(np.int64)
    least = node.copy()
    while True:
        before = least.copy()
        np.minimum.at(least, a, before[b])
        if (before == least).all():
            break
    for i in np.unique(a):
        yield int(node[i]), int(links[i]), int(least[i])


def matches(classes: DataFrame, dimension: int, cosine: float, block: int) -> DataFrame:
    """(node, links, least) of the classes of one length: linked vectors by task, and the least node reached there."""
    unit = stored(map_rows(classes.select("node", "copies", "embedding"), units,
                           "node long, copies long, unit binary"), "units")
    model = fit(unit, unit.count(), dimension, cosine)

    def code(batches: Batches) -> Iterable[list[tuple]]:
        for rows in batches:
            keys = model.keys(np.frombuffer(b"".join(r[2] for r in rows), "<f8").reshape(-1, dimension))
            yield [(*r, k.astype("<i4").tobytes(), k.tolist()) for r, k in zip(rows, keys)]

    coded = stored(map_rows(unit, code, "node long, copies long, unit binary, packed binary, keys array<long>"), "codes")
    placed = coded.select("node", "copies", "unit", "packed", F.posexplode("keys").alias("table", "key"))
    sizes = coded.select(F.posexplode("keys").alias("table", "key")).groupBy("table", "key").count()
    together = block_pairs(placed, sizes, ["table", "key"], "node", block).select(
        "table", "key", "low", "high", "block", "node", "copies", "unit", "packed")

    def match(batches: Batches) -> Iterable[list[tuple]]:
        rows = (row for batch in batches for row in batch)
        for (table, _, low, high), group in groupby(rows, lambda r: r[:4]):
            members = [(r[4], table, *r[5:]) for r in group]
            if len(members) > 1:
                yield list(compare(members, low, high, cosine, dimension))

    return stored(map_rows(together, match, "node long, links long, least long"), "found")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    Vectors are linked if their cosine is at least ``cosine``; each pair found is checked in double
    precision. Null and zero vectors, and those with null or non-finite numbers, link with
    nothing. Vectors of different lengths have no cosine; each length has a model and tables of its own, one after the
    other. Repeated rows are links of each other; rows with one vec_id have all its links. A
    row without vec_id is linked with nothing, has a null component and is kept. Columns other
    than vec_id and embedding are left out.
    """
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    usable = every.where(F.col("vec_id").isNotNull() & is_usable("embedding"))
    # Copies of a vector are one row, known by its least id.
    classes = stored(usable.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")), "classes")
    size = F.size("embedding")
    lengths = sorted(r["size"] for r in classes.select(size.alias("size")).distinct().collect())
    found = vectors.sparkSession.createDataFrame([], "node long, links long, least long")
    for dimension in lengths:
        found = found.unionByName(matches(classes.where(size == dimension), dimension, cosine, block))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("node").alias("u"), F.col("least").alias("v")))

    named = (classes.join(links, "node", "left").join(reached, "node", "left")
             .select("embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                     F.coalesce("component", "node").alias("component")))
    rows = (every.withColumn("_key", F.when(F.col("vec_id").isNotNull() & is_usable("embedding"), F.col("embedding")))
            .join(named.withColumnRenamed("embedding", "_key"), "_key", "left"))
    return rows.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(True)).alias("kept"))
