"""Token ids in files, compressed document by document with one shared zstandard dictionary.

A file set is a Parquet table of segments. A segment holds up to about a megabyte of documents
in ascending doc_id order: their zstandard frames one after the other (``frames``), an index
(``index``) and the hash of the dictionary they need. The index has, for each document, the end
of its frame, its number of ids and its doc_id, so that one short document is read without the
rest. The dictionary is trained on serialized ids of a bounded sample and lies beside the
segments. Shards are ranges of doc_id; only their sizes are added up in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from jobmetrics.llm.common import (
    LOWEST, Batches, bounded_sample, crc, id_bounds, map_rows, range_of, shuffle_width, whole_text,
)
from jobmetrics.llm.word_encoder import word_encoder

# The dictionary is fitted on at most this many documents, and this many characters of each, from a place
# anywhere in the text that a hash of the text gives.
SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS = 1_000, 4_096
DICTIONARY_BYTES = 64 * 1024
SEGMENT_BYTES = 1 << 20
LEVEL = 3
INDEX_ENTRY = np.dtype([("end", "<u8"), ("n_tokens", "<u8"), ("doc_id", "<i8"), ("null_id", "u1")])

FRAME_SCHEMA = "shard int, doc_id long, n_tokens long, ids_crc32 long, frame binary"
SEGMENT_SCHEMA = ("shard int, segment int, before long, n_documents long, n_tokens long, "
                  "dictionary_hash string, index binary, frames binary")
READ_SCHEMA = "shard int, doc_id long, start_in_shard long, n_tokens long, ids_crc32 long"


@dataclass(frozen=True)
class Dictionary:
    """Content of a zstandard dictionary, known by its hash; empty if there was nothing to learn from."""

    content: bytes

    @property
    def hash(self) -> str:
        return hashlib.sha256(self.content).hexdigest()


@lru_cache(maxsize=8)
def _coders(content: bytes):
    import zstandard

    shared = zstandard.ZstdCompressionDict(content) if content else None
    return (zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True),
            zstandard.ZstdDecompressor(dict_data=shared))


def serialize(ids: bytes) -> bytes:
    """Ids as the files hold them: two bytes each if all fit, else four; the first byte says which."""
    wide = np.frombuffer(ids, "<u4")
    if len(wide) and wide.max() >= 1 << 16:
        return b"\x04" + ids
    return b"\x02" + wide.astype("<u2").tobytes()


def deserialize(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4" if data[0] == 4 else "<u2", offset=1).astype("<u4")


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> Dictionary:
    """A dictionary from serialized documents; if they are too few to train on, their bytes themselves."""
    import zstandard

    if not any(samples):
        return Dictionary(b"")
    try:
        return Dictionary(zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes())
    except zstandard.ZstdError:
        return Dictionary(b"".join(samples)[:size])


def fit_dictionary(docs: DataFrame, vocabulary: str, pattern: str, end_id: int) -> Dictionary:
    """Trained on a bounded sample: SAMPLE_DOCUMENTS documents, SAMPLE_CHARACTERS of each, from anywhere in it."""
    # At most SAMPLE_DOCUMENTS ids, so they can be sent to every executor.
    ids = bounded_sample(docs.select("doc_id").where(F.col("doc_id").isNotNull()), SAMPLE_DOCUMENTS)
    hashed, length = F.xxhash64("text"), F.char_length("text")
    start = F.pmod(hashed, F.greatest(length - SAMPLE_CHARACTERS + 1, F.lit(1))).cast("int") + 1
    # Rows with one id may be many, so they are bounded again.
    sample = (docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(ids.distinct()), "doc_id")
              .select("doc_id", hashed.alias("hashed"), F.substring("text", start, F.lit(SAMPLE_CHARACTERS)).alias("text"))
              .orderBy("doc_id", "hashed").limit(SAMPLE_DOCUMENTS))
    texts = [row["text"] for row in sample.collect()]
    end = end_id.to_bytes(4, "little")
    return train_dictionary([serialize(ids + end) for ids in word_encoder(vocabulary, pattern).encode(texts)])


def write_token_files(docs: DataFrame, path: str, vocabulary: str, pattern: str, end_id: int,
                      shards: int | None = None) -> Dictionary:
    """Writes the ids of all rows under ``path``: ``segments`` and ``dictionary``.

    Null text is the end id alone; a null doc_id comes before all others; rows with one doc_id
    lie beside each other. Columns other than doc_id and text are left out.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    bounds = id_bounds(docs, "doc_id", shards or 2 * shuffle_width(spark))
    dictionary = fit_dictionary(docs, vocabulary, pattern, end_id)
    end = end_id.to_bytes(4, "little")

    def compress(batches: Batches) -> Iterable[list[tuple]]:
        encoder, (compressor, _) = word_encoder(vocabulary, pattern), _coders(dictionary.content)
        for rows in batches:
            out = []
            for (shard, doc, _), ids in zip(rows, encoder.encode([text for *_, text in rows])):
                ids += end
                out.append((shard, doc, len(ids) // 4, crc(ids), compressor.compress(serialize(ids))))
            yield out

    def segments(batches: Batches) -> Iterable[list[tuple]]:
        shard, held, size, number, before = None, [], 0, 0, 0
        for rows in batches:
            out = []
            for row in rows:
                if held and (row[0] != shard or size >= SEGMENT_BYTES):
                    out.append(segment(shard, number, before, held, dictionary.hash))
                    number, before = number + 1, before + out[-1][4]
                    held, size = [], 0
                if row[0] != shard:
                    shard, number, before = row[0], 0, 0
                held.append((row[1], row[2], row[4]))
                size += len(row[4])
            yield out
        if held:
            yield [segment(shard, number, before, held, dictionary.hash)]

    ranged = docs.select(range_of("doc_id", bounds).alias("shard"), "doc_id", "text")
    frames = map_rows(ranged, compress, FRAME_SCHEMA)
    ordered = (frames.repartition(F.col("shard"))
               .sortWithinPartitions("shard", "doc_id", "n_tokens", "ids_crc32"))
    # The frames are compressed already.
    map_rows(ordered, segments, SEGMENT_SCHEMA).write.option("compression", "none").parquet(f"{path}/segments")
    content = [(dictionary.hash, bytearray(dictionary.content))]
    spark.createDataFrame(content, "hash string, content binary").coalesce(1).write.parquet(f"{path}/dictionary")
    return dictionary


def segment(shard: int, number: int, before: int, held: list[tuple], dictionary_hash: str) -> tuple:
    """A row of the segment table from (doc_id, n_tokens, frame) in order."""
    index = np.zeros(len(held), INDEX_ENTRY)
    index["end"] = np.cumsum([len(frame) for *_, frame in held])
    index["n_tokens"] = [n for _, n, _ in held]
    index["doc_id"] = [LOWEST if doc is None else doc for doc, *_ in held]
    index["null_id"] = [doc is None for doc, *_ in held]
    return (shard, number, before, len(held), int(index["n_tokens"].sum()), dictionary_hash,
            index.tobytes(), b"".join(frame for *_, frame in held))


def read_segment(index: bytes, frames: bytes, dictionary: Dictionary) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of each document of a segment, in order."""
    decompress = _coders(dictionary.content)[1].decompress
    begin = 0
    for end, n_tokens, doc, null_id in np.frombuffer(index, INDEX_ENTRY).tolist():
        yield (None if null_id else doc), checked(decompress(frames[begin:end]), n_tokens)
        begin = end


def read_document(index: bytes, frames: bytes, number: int, dictionary: Dictionary) -> np.ndarray:
    """The ids of one document of a segment; only its own frame is decompressed."""
    entries = np.frombuffer(index, INDEX_ENTRY)
    begin = int(entries["end"][number - 1]) if number else 0
    data = _coders(dictionary.content)[1].decompress(frames[begin:int(entries["end"][number])])
    return checked(data, int(entries["n_tokens"][number]))


def checked(data: bytes, n_tokens: int) -> np.ndarray:
    ids = deserialize(data)
    if len(ids) != n_tokens:
        raise ValueError("the index and the frame disagree")
    return ids


def load_dictionary(spark: SparkSession, path: str) -> Dictionary:
    row = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = Dictionary(bytes(row["content"]))
    if dictionary.hash != row["hash"]:
        raise ValueError("the dictionary does not have the hash it was stored under")
    return dictionary


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files under ``path``.

    ``start`` counts the ids of all documents before. Shards, of which there are as many as the
    writer made ranges, are added up in one place; within a shard the segments carry their own.
    """
    dictionary = load_dictionary(spark, path)
    segments = spark.read.parquet(f"{path}/segments")

    def read(batches: Batches) -> Iterable[list[tuple]]:
        for rows in batches:
            for shard, before, stored_hash, index, frames in rows:
                if stored_hash != dictionary.hash:
                    raise ValueError("a segment needs another dictionary")
                out, start = [], before
                for doc, ids in read_segment(index, frames, dictionary):
                    out.append((shard, doc, start, len(ids), crc(ids.tobytes())))
                    start += len(ids)
                yield out

    found = map_rows(segments.select("shard", "before", "dictionary_hash", "index", "frames"), read, READ_SCHEMA)
    sizes = segments.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    so_far = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("shard", F.coalesce(so_far, F.lit(0)).alias("shard_start"))
    return (found.join(F.broadcast(starts), "shard")
            .select("doc_id", (F.col("start_in_shard") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32"))
