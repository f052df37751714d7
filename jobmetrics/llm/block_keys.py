"""Counting keys over blocks: blocks of a table ask about their keys, and get an answer for each.

A block is a set of rows that one task works on, such as a range of documents. It asks about each of its
distinct keys once, however often it has it, so a key with a third of all rows costs no more than any
other one in a block. Keys are dealt to parts by a hash; one task has all that was asked about the keys
of a part, and sends each block its answers in the order of its questions. An ask packs the keys of a
block and part into one row; where tables are so large that few are left in each, it is a row a key.

Keys are unsigned 64-bit numbers, or pairs of such (``(n, 2)`` arrays) where a hash has to be of 128 bits
to stand for what was hashed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from jobmetrics.llm.common import release, shuffle_width
from jobmetrics.llm.hashing import mixed

ASKS = "part long, block long, keys binary, counts binary"
# Keys of one part, about: what one task sorts at a time.
PART_KEYS = 1_000_000
# Fewer keys than this are not dealt to two parts for the sake of more tasks.
LEAST_PART_KEYS = 500_000

def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in ascending order, which one each key is, and how often each occurs."""
    if not len(keys):
        return keys, np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable") if keys.ndim == 1 else np.lexsort((keys[:, 1], keys[:, 0]))
    ordered = keys[order]
    changed = ordered[1:] != ordered[:-1]
    new = np.r_[True, changed if keys.ndim == 1 else changed.any(1)]
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    return ordered[starts], which, np.diff(np.r_[starts, len(keys)])


def part_count(spark: SparkSession, keys: int) -> int:
    """Parts for about so many keys: enough for a task each, but not more than there are blocks of keys worth a row."""
    return max(-(-keys // PART_KEYS), min(shuffle_width(spark), -(-keys // LEAST_PART_KEYS)), 1)


def _dealt(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Part of each key, and the order of the keys by part, with where each part starts."""
    hashed = mixed(keys if keys.ndim == 1 else keys[:, 0] ^ mixed(keys[:, 1]))
    part = ((hashed >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(part[order]) != 0]) if len(keys) else np.zeros(0, np.int64)
    return part, order, starts


def questions(block: int, keys: np.ndarray, counts: np.ndarray, parts: int) -> list[tuple]:
    """Rows of ASKS for the distinct ``keys`` of a block and how often it has them."""
    part, order, starts = _dealt(keys, parts)
    return [(int(part[at[0]]), block, np.ascontiguousarray(keys[at]).tobytes(), counts[at].astype(np.uint32).tobytes())
            for at in np.split(order, starts[1:]) if len(at)]


def answered_order(keys: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``keys`` the answers to ``questions`` are for, one after the other by part."""
    return _dealt(keys, parts)[1]


def answers(keys: np.ndarray, parts: int, received: Iterable[tuple[int, np.ndarray]]) -> np.ndarray:
    """The answers to ``questions``, one for each of ``keys``, from (part, answers) in any order."""
    found = [values for _, values in sorted(received, key=lambda r: r[0])]
    if not found:
        return np.zeros(0, np.int64)
    together = np.concatenate(found)
    out = np.empty_like(together)
    out[answered_order(keys, parts)] = together
    return out


class Part:
    """All that blocks ask about the keys of one part."""

    def __init__(self, blocks: Sequence[int], keys: Sequence[bytes], counts: Sequence[bytes], width: int) -> None:
        order = np.argsort(np.array(blocks, np.int64), kind="stable")
        self.blocks = [blocks[i] for i in order]
        shape = (-1,) if width == 1 else (-1, width)
        lists = [np.frombuffer(keys[i], np.uint64).reshape(shape) for i in order]
        self.cuts = np.cumsum([len(k) for k in lists])[:-1]
        self.keys, self.which, self.asked_by = distinct(np.concatenate(lists))
        asked = np.concatenate([np.frombuffer(counts[i], np.uint32) for i in order]).astype(np.int64)
        self.totals = np.zeros(len(self.keys), np.int64)
        np.add.at(self.totals, self.which, asked)

    def repeated(self) -> np.ndarray:
        """For each question whether the key occurs more than once in all blocks."""
        return (self.totals > 1)[self.which]

    def in_earlier_block(self) -> np.ndarray:
        """For each question whether a block of a lower number has the key."""
        first = np.full(len(self.keys), len(self.which))
        np.minimum.at(first, self.which, np.arange(len(self.which)))
        return first[self.which] < np.arange(len(self.which))

    def by_block(self, values: np.ndarray) -> list[tuple[int, np.ndarray]]:
        return list(zip(self.blocks, np.split(values, self.cuts)))


def answered(asks: DataFrame, width: int, answer: Callable[[int, Part], list[tuple]], schema: pa.Schema, ddl: str) -> DataFrame:
    """Rows that ``answer`` gives for each part's number and content; ``asks`` has the columns ASKS."""

    def run(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in ("block", "keys", "counts")]
        rows = answer(table.column("part")[0].as_py(), Part(*columns, width))
        values = zip(*rows) if rows else [[] for _ in schema]
        found = pa.table([pa.array(list(c), f.type) for c, f in zip(values, schema)], schema=schema)
        del columns, rows, values
        release()
        return found

    return asks.groupBy("part").applyInArrow(run, ddl)
