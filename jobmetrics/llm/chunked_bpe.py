"""Byte-level BPE of long texts in overlapping chunks, and decoding.

A long text is cut, in one pass, into chunks that overlap. Chunks are rows, dealt to tasks by document
and number, so those of one long document are worked on by different tasks. First each chunk is
pre-tokenised. Its first matches may be off, as it begins anywhere; but the pattern has no memory, so from
the first position at which two neighbouring chunks both begin a match, they agree. There the chunks are
stitched: the earlier one gives the piece before that position, the later one that from it on. Then the
pieces are encoded, each by the task that has its chunk, and a document's ids are decoded and digested
piece by piece, so that no task holds those of a whole document.

Documents of one chunk are encoded where they are read. Those with a match longer than the overlap, in which
neighbours need not meet, are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable
from functools import lru_cache
from itertools import groupby

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from jobmetrics.llm.common import Batches, map_rows, stored, whole_text

CHUNK, OVERLAP = 16_384, 1_024
# The pattern looks at most this many characters past the end of a match.
LOOK_AHEAD = 4
# Chunks that are handed on at a time.
AT_A_TIME = 64

KEY = ["doc_id", "text_hash"]
KEY_SCHEMA = "doc_id long, text_hash long, chunk int"
RESULT_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Codec:
    """Encoder and decoder over a file of ranks."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.matches = regex.compile(pattern).findall
        self.bytes_of = {i: b for b, i in ranks.items()}

    def encode(self, text: str) -> np.ndarray:
        return np.asarray(self.encoding.encode_ordinary(text), dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def digests(self, pieces: Iterable[np.ndarray]) -> tuple[int, str, str]:
        """(number of ids, digest of the ids, digest of the decoded bytes) of pieces one after another."""
        n, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
        for ids in pieces:
            n += len(ids)
            of_ids.update(ids.tobytes())
            of_bytes.update(self.decode(ids))
        return n, of_ids.hexdigest(), of_bytes.hexdigest()


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def cut(text: str, size: int, overlap: int) -> Iterable[str]:
    """The chunks of a text: ``size`` characters and the next ``overlap`` each, all that is left in the last."""
    chunks = max(1, -((overlap - len(text)) // size))
    for k in range(chunks):
        yield text[k * size:(k + 1) * size + overlap] if k < chunks - 1 else text[k * size:]


def match_starts(words: list[str]) -> np.ndarray:
    """Where matches begin that follow each other from position 0."""
    return np.cumsum([0] + [len(w) for w in words[:-1]]) if words else np.zeros(0, int)


def boundaries(c: Codec, text: str, size: int, overlap: int) -> tuple[list[int], list[int]]:
    """Where matches begin in a chunk's first ``overlap`` characters, and in those that the next chunk has too.

    Both are positions from the beginning of the overlap.
    """
    starts = match_starts(c.matches(text))
    tail = starts[(starts >= size) & (starts <= size + overlap - LOOK_AHEAD)] - size
    return starts[starts <= overlap].tolist(), tail.tolist()


def encode_piece(c: Codec, text: str, begin: int, end: int) -> np.ndarray:
    """Ids of ``text[begin:end]``, between two beginnings of matches, as within the text."""
    words = c.matches(text, begin)
    words = words[:int(np.searchsorted(begin + match_starts(words), end, "left"))]
    # White space that ends a text is one match, but several before a word: so not in one piece.
    single = len(words)
    while single and words[single - 1].isspace():
        single -= 1
    return np.concatenate([c.encode("".join(words[:single])), *[c.encode(w) for w in words[single:]]]).astype("<u4")


def is_short(size: int, overlap: int) -> Column:
    return F.char_length("text") <= size + overlap


def chunked(docs: DataFrame, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, text_hash, chunk, copies, text), a row for each chunk of ``docs`` (doc_id, text_hash, text).

    Chunks of repeated rows are one, combined before they are dealt out.
    """

    def run(batches: Batches) -> Iterable[list[tuple]]:
        for rows in batches:
            for doc, text_hash, text in rows:
                out = []
                for k, chunk in enumerate(cut(text, size, overlap)):
                    out.append((doc, text_hash, k, chunk))
                    if len(out) == AT_A_TIME:
                        yield out
                        out = []
                yield out

    every = map_rows(docs.select(*KEY, "text"), run, f"{KEY_SCHEMA}, text string")
    return every.groupBy(*KEY, "chunk").agg(F.count("*").alias("copies"), F.first("text").alias("text"))


def stitched(marks: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_hash, chunk, begin, end, broken) from the boundaries of chunks (head, tail).

    ``begin`` is null for a document's first chunk, ``end`` for its last: there is nothing to cut. ``broken``
    documents have neighbours that do not meet.
    """
    whole = Window.partitionBy(*KEY)
    order = whole.orderBy("chunk")
    meet = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    unmet = F.col("meet").isNull() & F.col("has_next")
    return (marks.select(*KEY, "chunk", meet.alias("meet"), F.lead("chunk").over(order).isNotNull().alias("has_next"))
            .select(*KEY, "chunk", F.lag("meet").over(order).alias("begin"),
                    F.when(F.col("has_next"), F.col("meet") + size).alias("end"), F.max(unmet).over(whole).alias("broken")))


def same(a: DataFrame, b: DataFrame, names: list[str]) -> list[Column]:
    return [a[n].eqNullSafe(b[n]) for n in names]


def encode_long(docs: DataFrame, ranks: str, pattern: str, size: int, overlap: int) -> DataFrame:
    """RESULT_SCHEMA for documents of several chunks (doc_id, text_hash, text)."""

    def mark(batches: Batches) -> Iterable[list[tuple]]:
        c = codec(ranks, pattern)
        for rows in batches:
            yield [(*key, *boundaries(c, text, size, overlap)) for *key, text in rows]

    def encode(batches: Batches) -> Iterable[list[tuple]]:
        c = codec(ranks, pattern)
        for rows in batches:
            yield [(*key, encode_piece(c, text, begin or 0, len(text) if end is None else end).tobytes())
                   for *key, text, begin, end in rows]

    def digest(batches: Batches) -> Iterable[list[tuple]]:
        c = codec(ranks, pattern)
        rows = (row for batch in batches for row in batch)
        for (doc, _, copies), pieces in groupby(rows, lambda r: r[:3]):
            yield [(doc, copies, *c.digests(np.frombuffer(p[3], "<u4") for p in pieces))]

    def encode_whole(batches: Batches) -> Iterable[list[tuple]]:
        c = codec(ranks, pattern)
        for rows in batches:
            yield [(doc, *c.digests([c.encode(text)])) for doc, text in rows]

    chunks = stored(chunked(docs, size, overlap), "chunks")
    marks = map_rows(chunks.select(*KEY, "chunk", "text"), mark, f"{KEY_SCHEMA}, head array<int>, tail array<int>")
    cuts = stored(stitched(marks, size), "cuts")

    sound = cuts.where(~F.col("broken"))
    to_encode = chunks.join(sound, same(chunks, sound, [*KEY, "chunk"])).select(
        chunks["doc_id"], chunks["text_hash"], chunks["copies"], chunks["chunk"], "text", "begin", "end")
    pieces = map_rows(to_encode, encode, "doc_id long, text_hash long, copies long, chunk int, ids binary")
    together = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "chunk").select(*KEY, "copies", "ids")
    found = map_rows(together, digest, "doc_id long, copies long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    repeated = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")

    broken = cuts.where(F.col("broken") & (F.col("chunk") == 0))
    again = docs.join(broken, same(docs, broken, KEY), "left_semi").select("doc_id", "text")
    return repeated.unionByName(map_rows(again, encode_whole, RESULT_SCHEMA))


def encode_and_decode(docs: DataFrame, ranks: str, pattern: str,
                      size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of ``docs``.

    Null text counts as empty: no ids, digests of nothing. Repeated rows give repeated results.
    Other columns of ``docs`` are left out, whatever their names.
    """
    if size <= overlap + LOOK_AHEAD or overlap <= LOOK_AHEAD:
        raise ValueError("a chunk must be longer than the overlap")

    def encode(batches: Batches) -> Iterable[list[tuple]]:
        c = codec(ranks, pattern)
        for rows in batches:
            yield [(doc, *c.digests([c.encode(text)])) for doc, text in rows]

    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    short = map_rows(every.where(is_short(size, overlap)), encode, RESULT_SCHEMA)
    long = every.where(~is_short(size, overlap)).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return short.unionByName(encode_long(long, ranks, pattern, size, overlap))
