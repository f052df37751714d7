"""Chunked encoding against the library's own, and exact decoding."""

from __future__ import annotations

import hashlib
import random
import time

import numpy as np
import pytest
from llm_helpers import EDGES, documents, edges, nothing, prepared, words  # noqa: F401

from jobmetrics.llm import chunked_bpe as cb
from jobmetrics.llm.queries import PATTERN, RANKS


def expected(text: str) -> tuple[int, str, str]:
    ids = np.array(cb.codec(RANKS, PATTERN).encoding.encode_ordinary(text), "<u4")
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def odd_text(seed: int, n: int) -> str:
    draw = random.Random(seed)
    parts = [" ", "  ", "\n", "\n\n ", "'s", "'re", "'", "don't", "é", "漢字", "😀", "12", "3.5", "_", "a", "the", "ing", "\t", " "]
    return "".join(draw.choice(parts) for _ in range(n))


@pytest.mark.parametrize("size, overlap", [(32, 12), (64, 24), (200, 50)])
def test_small_chunks_give_the_same_ids(prepared, size, overlap):
    texts = [odd_text(i, n) for i, n in enumerate([1, 5, 30, 31, 33, 100, 500, 2000])]
    texts += [words(300, 1), "x" * 700 + " y", "it's " * 200, " " * 300 + "a", "a" + "\n" * 333 + "b"]
    docs = documents(prepared, list(enumerate(texts)))
    got = {r["doc_id"]: tuple(r[1:]) for r in cb.encode_and_decode(docs, RANKS, PATTERN, size, overlap).collect()}
    assert got == {i: expected(t) for i, t in enumerate(texts)}


def test_edges(edges):
    got = sorted((tuple(r) for r in cb.encode_and_decode(edges, RANKS, PATTERN).collect()), key=str)
    assert got == sorted(((doc, *expected(text or "")) for doc, text in EDGES), key=str)


def test_whole_table(prepared, sf_dir):
    docs = prepared.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: tuple(r[1:]) for r in cb.encode_and_decode(docs, RANKS, PATTERN).collect()}
    assert got == {r["doc_id"]: expected(r["text"] or "") for r in docs.collect()}


def test_empty_table_and_bad_sizes(nothing):
    assert cb.encode_and_decode(nothing, RANKS, PATTERN).collect() == []
    with pytest.raises(ValueError):
        cb.encode_and_decode(nothing, RANKS, PATTERN, 8, 8)


def test_cutting_takes_time_in_proportion_to_the_text():
    def seconds(n):
        text, begun = "ab c" * (n // 4), time.perf_counter()
        assert sum(len(c) for c in cb.cut(text, cb.CHUNK, cb.OVERLAP)) >= n
        return time.perf_counter() - begun

    short = min(seconds(8 << 20) for _ in range(3))
    assert seconds(64 << 20) < 24 * short + 0.5  # the square would be 64 times


@pytest.mark.parametrize("n", [1, 43, 44, 45, 75, 76, 77, 76 + 32, 77 + 32])
def test_chunks_hold_the_whole_text(n):
    text = "".join(chr(97 + i % 26) for i in range(n))
    chunks = list(cb.cut(text, 32, 12))
    assert "".join(c[:32] for c in chunks[:-1]) + chunks[-1] == text and len(chunks[-1]) <= 44
    assert all(len(c) == 44 for c in chunks[:-1])


def test_copies_null_ids_and_long_matches(prepared):
    """Copies are as many as they were; a match longer than the overlap has its document encoded whole."""
    long, run = odd_text(3, 4000), words(400, 4) + "y" * 900 + words(400, 5)
    rows = [(1, long)] * 3 + [(None, long), (None, long), (None, run), (2, run), (1, run), (2, run + " "), (3, "a \n\nb" * 90)]
    got = sorted((tuple(r) for r in cb.encode_and_decode(documents(prepared, rows), RANKS, PATTERN, 200, 50).collect()), key=str)
    assert got == sorted(((doc, *expected(text)) for doc, text in rows), key=str)


def test_a_very_long_text_is_shared_by_tasks(prepared):
    text = words(400_000, 6)
    docs = documents(prepared, [(1, text)]).selectExpr("doc_id", "xxhash64(text) AS text_hash", "text")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    prepared.conf.set(key, "false")
    try:
        parts = {r["p"] for r in cb.chunked(docs).selectExpr("spark_partition_id() AS p").collect()}
    finally:
        prepared.conf.unset(key)
    assert len(parts) > 1
    got = [tuple(r) for r in cb.encode_and_decode(documents(prepared, [(1, text)]), RANKS, PATTERN).collect()]
    assert got == [(1, *expected(text))]
