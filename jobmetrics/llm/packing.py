"""Packing documents into windows of a fixed length by the sum-of-squares rule.

A document's ids, with its end id, are cut into whole windows and a rest. The rests are placed
online: each goes into the fill level that leaves the smallest sum of squared counts of partly
filled windows, where one array holds how many windows are open at each level. When a task's
documents are over, the windows still open are emptied into each other, the fullest first, which
may cut pieces; the last one is cut at powers of two, so that nothing of it needs padding.

Each task packs what it reads, with no shuffle: a window never spans tasks, and a task that is
run again packs the same rows the same way. A task holds the ids of its open windows only.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from jobmetrics.llm.common import Batches, crc, map_rows, whole_text
from jobmetrics.llm.word_encoder import WORDS_KEPT, word_encoder

WINDOW = 1024
PIECES_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                 "sequence_id long, offset long")
ID_BYTES = 4

# A piece: (doc_id, start, ids as bytes, tokens of the document).
Piece = tuple[int | None, int, bytes, int]


class SumOfSquares:
    """Open windows by fill level; ``place`` returns the pieces of a window that became full."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[deque[list[Piece]]] = [deque() for _ in range(window + 1)]
        self.levels = np.arange(window + 1)

    def level_for(self, size: int) -> int:
        """The level to add ``size`` to, 0 for a new window; of equals the fullest."""
        n = self.count
        # The change of the sum of squares, halved and without constants, of h -> h + size:
        # the window leaves level h and joins level h + size; a full window joins none.
        highest = self.window - size
        leaves = -n[:highest + 1].astype(float) + 0.5
        leaves[0] = 0.0
        joins = n[size:size + highest + 1] + 0.5
        joins[highest] = 0.0
        change = leaves + joins
        change[(n[:highest + 1] == 0) & (self.levels[:highest + 1] > 0)] = np.inf
        return int(highest - np.argmin(change[::-1]))

    def place(self, piece: Piece) -> list[Piece] | None:
        size = len(piece[2]) // ID_BYTES
        level = self.level_for(size)
        window = []
        if level:
            window = self.open[level].popleft()
            self.count[level] -= 1
        window.append(piece)
        if level + size == self.window:
            return window
        self.open[level + size].append(window)
        self.count[level + size] += 1
        return None

    def rest(self) -> Iterator[list[Piece]]:
        """Closes all: fills the fullest from the emptiest, then cuts the last at powers of two."""
        left = deque(w for level in reversed(self.open) for w in level)
        self.count[:] = 0
        self.open = [deque() for _ in self.open]
        while left:
            window = left.popleft()
            room = self.window - size_of(window)
            while room and left:
                piece = left[-1].pop()
                taken, kept = cut(piece, room)
                window.append(taken)
                if kept:
                    left[-1].append(kept)
                elif not left[-1]:
                    left.pop()
                room = self.window - size_of(window)
            if not room:
                yield window
            else:
                yield from powers_of_two(window)


def size_of(window: list[Piece]) -> int:
    return sum(len(p[2]) for p in window) // ID_BYTES


def cut(piece: Piece, size: int) -> tuple[Piece, Piece | None]:
    doc, start, ids, tokens = piece
    at = size * ID_BYTES
    if len(ids) <= at:
        return piece, None
    return (doc, start, ids[:at], tokens), (doc, start + size, ids[at:], tokens)


def powers_of_two(window: list[Piece]) -> Iterator[list[Piece]]:
    """The window's pieces in windows whose sizes are its length's powers of two."""
    length, pieces = size_of(window), deque(window)
    for bit in reversed(range(length.bit_length())):
        size, part = length & (1 << bit), []
        while size:
            taken, kept = cut(pieces.popleft(), size)
            if kept:
                pieces.appendleft(kept)
            part.append(taken)
            size -= len(taken[2]) // ID_BYTES
        if part:
            yield part


def packed(documents: Iterable[tuple[int | None, bytes]], window: int = WINDOW) -> Iterator[list[Piece]]:
    """Windows for documents given as (doc_id, ids as bytes, their end id included)."""
    levels, step = SumOfSquares(window), window * ID_BYTES
    for doc, ids in documents:
        tokens = len(ids) // ID_BYTES
        whole = len(ids) - len(ids) % step
        for at in range(0, whole, step):
            yield [(doc, at // ID_BYTES, ids[at:at + step], tokens)]
        if whole < len(ids):
            full = levels.place((doc, whole // ID_BYTES, ids[whole:], tokens))
            if full:
                yield full
    yield from levels.rest()


def pack(docs: DataFrame, vocabulary: str, pattern: str, end_id: int = 0, window: int = WINDOW,
         words_kept: int = WORDS_KEPT) -> DataFrame:
    """One row for each piece of each row of ``docs``; offsets are gapless within a sequence.

    A document without text is its end id alone. Repeated rows and null ids are packed like any
    other row; an empty table gives no rows. Columns other than doc_id and text are left out.
    ``window`` must be a power of two. ``words_kept`` bounds the pre-tokens that a worker keeps with their ids:
    fewer take less memory and more time, and give the same rows.
    """
    end = end_id.to_bytes(ID_BYTES, "little")

    def run(batches: Batches) -> Iterable[list[tuple]]:
        encoder = word_encoder(vocabulary, pattern, words_kept)
        first = TaskContext.get().partitionId() << 40

        def documents() -> Iterator[tuple[int | None, bytes]]:
            for rows in batches:
                for (doc, _), ids in zip(rows, encoder.encode([text for _, text in rows])):
                    yield doc, ids + end

        out = []
        for number, pieces in enumerate(packed(documents(), window)):
            offset = 0
            for doc, start, ids, tokens in pieces:
                length = len(ids) // ID_BYTES
                out.append((doc, start, length, crc(ids), tokens, first + number, offset))
                offset += length
            if len(out) >= 10_000:
                yield out
                out = []
        yield out

    return map_rows(docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")), run, PIECES_SCHEMA)
