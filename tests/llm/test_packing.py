"""Packing: exact pieces, gapless windows, the placing rule by brute force."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st
from llm_helpers import EDGES, documents, edges, nothing, prepared, words  # noqa: F401
from test_token_files import ids_by_library

from jobmetrics.llm import packing
from jobmetrics.llm.queries import PATTERN, VOCABULARY


def is_power_of_two(n: int) -> bool:
    return n & (n - 1) == 0


def check(rows, texts):
    """All ids of all documents in exactly one piece each, windows without gaps."""
    wanted = defaultdict(list)
    for (doc, _), ids in zip(texts, ids_by_library([t or "" for _, t in texts])):
        wanted[doc, len(ids) + 1].append(np.array([*ids, 0], "<u4"))
    windows, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
    for window in windows.values():
        at = 0
        for offset, length in sorted(window):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
    for (doc, n), copies in wanted.items():
        cover = np.zeros(n, int)
        for start, length, crc in pieces.pop((doc, n)):
            assert crc in {zlib.crc32(ids[start:start + length].tobytes()) for ids in copies}
            cover[start:start + length] += 1
        assert (cover == len(copies)).all()
    assert not pieces
    return windows


def test_edges(edges):
    check(packing.pack(edges, VOCABULARY, PATTERN).collect(), EDGES)


def test_whole_table_has_no_padding(prepared, sf_dir):
    docs = prepared.read.parquet(f"{sf_dir}/documents.parquet")
    windows = check(packing.pack(docs, VOCABULARY, PATTERN).collect(),
                    [(r["doc_id"], r["text"]) for r in docs.collect()])
    sizes = [sum(length for _, length in w) for w in windows.values()]
    assert sum(1024 - n for n in sizes if not is_power_of_two(n)) == 0
    tasks = len({s >> 40 for s in windows})
    assert sum(n < 1024 for n in sizes) <= 10 * tasks


def test_empty_table(nothing):
    assert packing.pack(nothing, VOCABULARY, PATTERN).collect() == []


def test_tasks_have_their_own_windows(prepared):
    docs = documents(prepared, [(i, words(i % 50 + 1, i)) for i in range(200)]).repartition(5)
    rows = packing.pack(docs, VOCABULARY, PATTERN).collect()
    check(rows, [(i, words(i % 50 + 1, i)) for i in range(200)])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 31), max_size=80))
def test_level_has_the_least_sum_of_squares(sizes):
    levels = packing.SumOfSquares(32)
    for size in sizes:
        count = levels.count.copy()

        def total(level):
            after = count.copy()
            if level:
                after[level] -= 1
            if level + size < 32:
                after[level + size] += 1
            return int((after ** 2).sum())

        possible = [h for h in range(32 - size + 1) if h == 0 or count[h]]
        assert total(levels.level_for(size)) == min(map(total, possible))
        levels.place((1, 0, bytes(4 * size), size))


def test_rests_are_filled_up():
    draw = random.Random(3)
    docs = [(i, bytes(4 * draw.randint(1, 3000))) for i in range(300)]
    windows = list(packing.packed(docs))
    sizes = [packing.size_of(w) for w in windows]
    assert sum(sizes) == sum(len(b) // 4 for _, b in docs)
    short = [n for n in sizes if n < 1024]
    assert len(short) <= 10 and all(map(is_power_of_two, short)) and len(set(short)) == len(short)
