"""Removed words against a version in plain Python that knows every window."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from llm_helpers import EDGES, documents, edges, nothing, prepared, words  # noqa: F401

from jobmetrics.llm import repeated_windows as rw
from jobmetrics.llm.queries import queries


def brute(rows, length):
    """(doc_id, words, removed, kept) of (doc_id, text) with distinct ids, or null ones in the given order."""
    split = [(doc, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for doc, text in rows]
    first: dict[tuple, tuple] = {}
    for doc, found in split:
        for at in range(len(found) - length + 1):
            window = tuple(found[at:at + length])
            first[window] = min(first.get(window, (doc, at)), (doc, at))
    out = []
    for doc, found in split:
        gone = [False] * len(found)
        for at in range(len(found) - length + 1):
            if first[tuple(found[at:at + length])] < (doc, at):
                gone[at:at + length] = [True] * length
        out.append((doc, len(found), sum(gone), " ".join(w for w, g in zip(found, gone) if not g)))
    return out


def got(docs, length):
    return [tuple(r) for r in rw.without_repeats(docs, length).select("doc_id", "n_words", "n_removed", "kept").collect()]


def test_levels():
    assert rw.levels(20) == [10, 20] and rw.levels(64) == [8, 16, 32, 64] and rw.levels(7) == [7] and rw.levels(30) == [15, 30]


@pytest.mark.parametrize("length", [1, 2, 7, 10, 20, 37])
def test_window_hashes_depend_on_their_words_only(length):
    draw = np.random.default_rng(1).integers(0, 1 << 63, 200, np.uint64)
    twice = np.r_[draw[:60], draw[100:], draw[:60]]
    hashed = rw.window_hashes(twice, length, 0)
    assert len(hashed) == len(twice) - length + 1
    assert (hashed[:60 - length + 1] == hashed[160:]).all() and len(set(hashed.tolist())) == len(hashed) - (60 - length + 1)
    assert rw.window_hashes(draw[:length - 1], length, 0).size == 0


def test_whole_table_against_brute_force(prepared, sf_dir):
    docs = prepared.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    found = got(docs, 20)
    assert sorted(found) == sorted(brute(rows, 20))
    assert sum(r[2] for r in found) > 1000
    query = queries()["op13_repeated_windows"](prepared, sf_dir)
    assert query.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"] and query.count() == len(rows)


@pytest.mark.parametrize("length", [3, 8, 16, 20, 32])
def test_passages_of_all_lengths(prepared, length):
    """Passages around the window's length, at starts, ends and within documents, repeated within one too."""
    draw = random.Random(length)
    shared = [words(n, 100 + n).split() for n in range(length - 2, 2 * length + 3)]
    rows = []
    for doc in range(120):
        parts = []
        for _ in range(draw.randint(0, 4)):
            parts += words(draw.randint(0, 30), draw.random()).split() if draw.random() < 0.6 else []
            parts += draw.choice(shared)
        rows.append((doc * 3 - 50, " ".join(parts)))
    docs = documents(prepared, rows)
    want = sorted(brute(rows, length))
    assert sorted(got(docs, length)) == want and sum(r[2] for r in want) > 500
    assert sorted(got(docs.repartition(7, "text"), length)) == want


def test_copies_hold_a_third_of_all_rows(prepared):
    rows = [(i, words(60, 7) if i % 3 == 0 else f"{words(25, 9)} {words(30, i)}") for i in range(300)]
    assert sorted(got(documents(prepared, rows), 20)) == sorted(brute(rows, 20))


def test_a_passage_within_one_document_and_overlapping_itself(prepared):
    rows = [(1, " ".join(["a"] * 50)), (2, "a b " * 30), (3, words(30, 1) + " x " + words(30, 1))]
    want = sorted(brute(rows, 20))
    assert sorted(got(documents(prepared, rows), 20)) == want
    assert [r[2] for r in want] == [49, 58, 30]


def test_edges(prepared, edges, nothing):
    found = rw.without_repeats(edges, 20).collect()
    assert len(found) == len(EDGES)
    by_id = {}
    for row in found:
        by_id.setdefault(row["doc_id"], []).append(row)
    # Rows with one id are one place: equal windows at equal words are no repetition.
    assert [r["n_removed"] for r in by_id[5]] == [0, 0] and by_id[5][0]["n_words"] == 30_000
    big = by_id[max(d for d in by_id if d is not None)][0]
    assert (big["n_words"], big["n_removed"], big["kept"]) == (41, 40, "more")
    assert [(s["start"], s["end"]) for s in big["removed"]] == [(0, 40)]
    assert by_id[3][0]["kept"] == "" and by_id[11][0]["kept"] == "A B C" and by_id[8][0]["kept"].startswith("漢字 かな")
    assert sorted((r["n_words"], r["kept"]) for r in by_id[None]) == [(0, ""), (2, "no id")]
    assert rw.without_repeats(nothing, 20).collect() == []


def test_rows_without_an_id_come_last(prepared):
    rows = [(None, words(40, 1)), (None, words(40, 1)), (9, words(40, 1)), (None, words(40, 2))]
    found = sorted((r["doc_id"] is None, r["n_removed"]) for r in rw.without_repeats(documents(prepared, rows), 20).collect())
    assert found == [(False, 0), (True, 0), (True, 40), (True, 40)]


def test_texts_are_shuffled_once(prepared, sf_dir):
    from conftest import plan_of

    result = rw.without_repeats(prepared.read.parquet(f"{sf_dir}/documents.parquet"))
    result.collect()
    final = plan_of(result).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final
