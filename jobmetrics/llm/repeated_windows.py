"""Substring de-duplication: words of passages that also start earlier in the corpus.

A window is ``length`` consecutive words of one document. Repeated windows are found level by level,
each level twice as long as the one before: 10 and then 20 words for windows of 20. At a level shorter than
``length`` a window is represented by that one of its shorter windows with the least hash, which is the
same one wherever the window occurs; neighbours mostly share it, so that few have to be asked about. Windows
whose representative is repeated alone go on to the level of twice that length. At ``length`` itself a
window stands for itself, by 128 bits. Doubling ends there, or before where no candidates survive: longer
windows could add nothing, as each of their parts of ``length`` words is found already.

Documents are dealt to blocks, ranges of their ids. A block asks once about each of its keys (see
``block_keys``), and whether a key is in an earlier block says whether its windows start in an earlier document;
within a block that is found directly. The texts are shuffled once, all levels read the same exchange.

Defined results: null and empty texts have no words. Rows with one doc_id are one place in the order, of
which a window is repeated if it starts at a later word than in another of them. Rows without an id come after
all others, in the order of a hash of their text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmetrics.llm.block_keys import ASKS, Part, answered, answers, distinct, part_count, questions
from jobmetrics.llm.common import id_bounds, range_of, shuffle_width, whole_text
from jobmetrics.llm.hashing import joined, word_hashes

# Bytes of text in a block, about; a task holds some ten times as much.
BLOCK_BYTES = 16 << 20
# Less text than this is not cut into two blocks for the sake of more tasks.
LEAST_BLOCK_BYTES = 1 << 20
# Windows shorter than this are too frequent by chance to be worth asking about.
LEAST_LENGTH = 8

_REPLIES = pa.schema([("block", pa.int64()), ("level", pa.int32()), ("part", pa.int64()), ("n", pa.int64()), ("bits", pa.binary())])
_REPLIES_DDL = "block long, level int, part long, n long, bits binary"
_ASKS = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()), ("removed", pa.list_(_SPAN))])
_KEPT_DDL = "doc_id long, n_words long, n_removed long, kept binary, removed array<struct<start: long, end: long>>"


def levels(length: int) -> list[int]:
    """Window lengths, each twice the one before, up to ``length``."""
    found = [length]
    while found[0] % 2 == 0 and found[0] // 2 >= LEAST_LENGTH:
        found.insert(0, found[0] // 2)
    return found


def window_hashes(words: np.ndarray, length: int, stream: int) -> np.ndarray:
    """Hash of the ``length`` words from each word on, from the hashes of the words."""
    done, hashed, size, doubled = 0, None, 1, words
    while True:
        if length & size:
            hashed = doubled if hashed is None else joined(hashed[:len(doubled) - done] if len(doubled) > done else hashed[:0],
                                                           doubled[done:], stream)
            done += size
        size *= 2
        if size > length:
            return hashed
        half = size // 2
        doubled = joined(doubled[:-half], doubled[half:], stream) if len(doubled) > half else doubled[:0]


def rolling(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least, or greatest, of each ``width`` consecutive values."""
    choose, size = (np.minimum, 1) if least else (np.maximum, 1)
    while 2 * size <= width:
        values = choose(values[:-size], values[size:]) if len(values) > size else values[:0]
        size *= 2
    rest = width - size
    return values if not rest else choose(values[:-rest], values[rest:]) if len(values) > rest else values[:0]


class Block:
    """The words of a block's documents, in their order, and which windows are still candidates."""

    def __init__(self, table: pa.Table, length: int) -> None:
        self.length = length
        ids, places, texts = (table.column(c).to_pylist() for c in ("doc_id", "place", "text"))
        order = sorted(range(len(ids)), key=places.__getitem__)
        self.ids = [ids[i] for i in order]
        place = np.array([places[i] for i in order], np.int64)
        self.texts = [texts[i] for i in order]
        self.words, self.sizes = word_hashes(self.texts)
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        # Order of the documents, equal for equal places, and the number of a word in its document.
        rank = np.cumsum(np.r_[0, np.diff(place) != 0]) if len(place) else place
        self.rank = np.repeat(rank, self.sizes)
        self.at = np.arange(len(self.words)) - np.repeat(self.starts[:-1], self.sizes)
        self.alive = self.at <= np.repeat(self.sizes, self.sizes) - length

    def representatives(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the windows of ``level`` words, and the least one in each candidate (else 0)."""
        hashed, total = window_hashes(self.words[:, 0], level, 0), len(self.words)
        hashed = np.r_[hashed, np.zeros(total - len(hashed), np.uint64)]
        least = rolling(hashed, self.length - level + 1, least=True)
        least = np.r_[least, np.zeros(total - len(least), np.uint64)]
        return hashed, np.where(self.alive, least, np.uint64(0))

    def asked(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys of a level, the candidates, which key each one has, and in how many places each key is."""
        candidates = np.flatnonzero(self.alive)
        if level == self.length:
            pairs = np.stack([window_hashes(self.words[:, s], level, s)[candidates] for s in (0, 1)], 1)
            keys, which, counts = distinct(pairs)
            return keys, candidates, which, counts
        hashed, least = self.representatives(level)
        width = self.length - level + 1
        # A window represents a candidate if it has the least hash of one of those that hold it.
        most = rolling(np.r_[np.zeros(width - 1, np.uint64), least], width, least=False)
        keys, _, counts = distinct(hashed[(hashed == most) & (most > 0)])
        return keys, candidates, np.searchsorted(keys, least[candidates]), counts

    def narrow(self, level: int, repeated: np.ndarray, keys_asked: tuple) -> None:
        _, candidates, which, _ = keys_asked
        self.alive[candidates[~repeated[which]]] = False

    def covered(self, earlier: np.ndarray, keys_asked: tuple) -> np.ndarray:
        """For each word whether a window that also starts earlier covers it."""
        keys, candidates, which, _ = keys_asked
        place = self.rank[candidates] << 40 | self.at[candidates]
        first = np.full(len(keys), np.iinfo(np.int64).max)
        np.minimum.at(first, which, place)
        repeated = candidates[earlier[which] | (place > first[which])] if len(candidates) else candidates
        change = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(change, repeated, 1)
        np.add.at(change, repeated + self.length, -1)
        return np.cumsum(change)[:-1] > 0

    def kept(self, covered: np.ndarray) -> list[tuple]:
        rows = []
        for doc, text, start, end in zip(self.ids, self.texts, self.starts, self.starts[1:]):
            words, gone = text.split(), covered[start:end]
            edges = np.flatnonzero(np.diff(np.r_[False, gone, False])).reshape(-1, 2).tolist()
            left = words if not edges else [w for w, g in zip(words, gone.tolist()) if not g]
            rows.append((doc, len(words), int(gone.sum()), b" ".join(left), [{"start": a, "end": b} for a, b in edges]))
        return rows


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _narrowed(table: pa.Table, replies: pa.Table, length: int, parts: int, upto: int) -> tuple[Block, np.ndarray | None, tuple | None]:
    """The block after the answers to the first ``upto`` levels; and the last ones, if those were about whole windows."""
    block, received = Block(table, length), {}
    for level, part, n, bits in zip(*[replies.column(c).to_pylist() for c in ("level", "part", "n", "bits")]):
        received.setdefault(level, []).append((part, np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)))
    for level in levels(length)[:upto]:
        asked = block.asked(level)
        found = answers(asked[0], parts, received.get(level, [])).astype(bool)
        if level == length:
            return block, found, asked
        block.narrow(level, found, asked)
    return block, None, None


def in_blocks(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, text, place and block of each document, and a number of parts for its keys."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    count = max(-(-size // BLOCK_BYTES), min(2 * shuffle_width(spark), -(-size // LEAST_BLOCK_BYTES)), 1)
    bounds = id_bounds(texts.where(F.col("doc_id").isNotNull()), "doc_id", count)
    hashed = F.xxhash64("text")
    later = F.lit(count + 1) + F.floor((hashed / F.lit(2.0 ** 64) + 0.5) * count)
    missing = F.col("doc_id").isNull()
    blocks = texts.select(
        "doc_id", F.col("text").cast("binary").alias("text"), F.when(missing, hashed).otherwise(F.col("doc_id")).alias("place"),
        F.when(missing, later).otherwise(range_of("doc_id", bounds)).cast("long").alias("block"))
    # A task a block, however many there are. At most one of about six windows is asked about, of as many words of six bytes.
    return blocks.repartition(count, "block"), part_count(spark, size // 36)


def without_repeats(docs: DataFrame, length: int = 20) -> DataFrame:
    """For each document: ``n_words``, ``n_removed``, ``kept`` (its other words, joined by spaces) and ``removed`` (spans of words)."""
    blocks, parts = in_blocks(docs)
    spark: SparkSession = docs.sparkSession
    replies = spark.createDataFrame([], _REPLIES_DDL)
    steps = levels(length)

    def asks(upto: int):
        def run(table: pa.Table, replies: pa.Table) -> pa.Table:
            if not len(table):
                return _table([], _ASKS)
            number = table.column("block")[0].as_py()
            block = _narrowed(table, replies, length, parts, upto)[0]
            keys, _, _, counts = block.asked(steps[upto])
            return _table(questions(number, keys, counts, parts), _ASKS)
        return run

    def answer(level: int):
        def run(part: int, asked: Part) -> list[tuple]:
            found = asked.in_earlier_block() if level == length else asked.repeated()
            return [(block, level, part, len(bits), np.packbits(bits).tobytes()) for block, bits in asked.by_block(found)]
        return run

    def kept(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table):
            return _table([], _KEPT)
        block, earlier, asked = _narrowed(table, replies, length, parts, len(steps))
        return _table(block.kept(block.covered(earlier, asked)), _KEPT)

    for upto, level in enumerate(steps):
        asked = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(asks(upto), ASKS)
        replies = replies.unionByName(answered(asked, 2 if level == length else 1, answer(level), _REPLIES, _REPLIES_DDL))
    result = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(kept, _KEPT_DDL)
    return result.withColumn("kept", F.col("kept").cast("string"))
