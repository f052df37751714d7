"""Near-duplicates and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_helpers import BIG, EDGES, documents, edges, nothing, prepared, words  # noqa: F401

from jobmetrics.llm import minhash as mh
from jobmetrics.llm.components import components

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, width):
    found = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return {tuple(found[i:i + width]) for i in range(max(1, len(found) - width + 1))} if found else set()


def least_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def expected(rows, width, percent=80):
    """(doc_id, n_shingles, component_id, kept) of each row; rows with one id are one document."""
    sets = [(doc, shingle_set(text, width)) for doc, text in rows]
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if a is not None and b is not None
             and x and y and 100 * len(x & y) >= percent * len(x | y)]
    least = least_reachable({d for d, _ in sets if d is not None}, links)
    out = []
    for doc, found in sets:
        component = least.get(doc) if found else doc
        out.append((doc, len(found), component, doc is None or component == doc))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("width", [4, 5])
def test_whole_table(prepared, sf_dir, width):
    docs = prepared.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(mh.near_duplicates(docs, width)) == expected(rows, width)


def test_edges(prepared, edges):
    assert got(mh.near_duplicates(edges, 4)) == expected(EDGES, 4)


def test_empty_table(nothing):
    assert mh.near_duplicates(nothing, 4).collect() == []


def test_edited_copies_chains_and_a_group_of_copies(prepared):
    draw = random.Random(1)
    rows = []
    for family in range(6):
        text = words(120, family).split()
        for step in range(25):  # each a little further from the first
            rows.append((1000 * family + step, " ".join(text)))
            text[draw.randrange(len(text))] = f"new{family}x{step}"
    rows += [(BIG - i, "the very same words in all of these rows") for i in range(300)]
    rows += [(50_000 + i, words(50, 99) + " " + words(20, i)) for i in range(40)]  # a shared passage
    draw.shuffle(rows)
    want = expected(rows, 4)
    assert len({r[2] for r in want}) < len(rows) / 2
    assert got(mh.near_duplicates(documents(prepared, rows), 4)) == want


@pytest.mark.parametrize("block", [8, 2048])
def test_members_of_a_bucket_that_hubs_do_not_link(prepared, monkeypatch, block):
    """Links between members that are not similar to their hubs are found in the second step,
    also where a bucket is cut into blocks."""
    monkeypatch.setattr(mh, "MEMBERS", block)
    rows = []
    for pair in range(30):
        base = words(60, 7).split() + words(25, 100 + pair).split()
        rows += [(2 * pair, " ".join(base)), (2 * pair + 1, " ".join([*base, "last"]))]
    assert got(mh.near_duplicates(documents(prepared, rows), 4)) == expected(rows, 4)


def test_the_largest_component_of_a_bucket_meets_only_the_others(prepared):
    """Every two members of different components meet in a task, and a large component is not dealt against itself."""
    rows = [(7, 0, doc, 1 if doc < 900 else doc // 5, 10, b"") for doc in range(1000)] + [(8, 1, d, d % 2, 10, b"") for d in range(9)]
    members = prepared.createDataFrame(rows, "bucket long, band int, doc_id long, component long, n_shingles long, signature binary")
    dealt = mh.dealt_by_component(members, members.groupBy("bucket").count(), 32).collect()
    tasks, component = {}, {(r[0], r[2]): r[3] for r in rows}
    for r in dealt:
        tasks.setdefault((r["bucket"], r["low"], r["high"]), []).append((r["doc_id"], r["block"]))
    met = set()
    for (bucket, low, high), docs in tasks.items():
        assert len(docs) < 130
        met |= {(bucket, a, b) for a, x in docs for b, y in docs if a < b and (low == high or x != y)}
    wanted = {(7, a, b) for a in range(1000) for b in range(max(a + 1, 900), 1000) if component[7, a] != component[7, b]}
    assert wanted <= met and not any(b < 900 for bucket, _, b in met if bucket == 7)
    assert {(8, a, b) for a in range(9) for b in range(a + 1, 9)} <= met
    # 900 members meet 4 blocks of others; 100 others meet 29 blocks and each other.
    assert sum(len(d) for k, d in tasks.items() if k[0] == 7) == 900 * 4 + 100 * (29 + 4)


def test_buckets_hold_what_signatures_say(prepared):
    """Signatures that agree in a band, as they are kept, share its bucket: so a pair can be left to an earlier band."""
    signed = np.arange(mh.HASHES, dtype="<u2")
    other = signed.copy()
    other[:mh.ROWS * 3] += 7
    same = mh.bucket_keys(signed) == mh.bucket_keys(other)
    assert same.tolist() == [False] * 3 + [True] * (mh.BANDS - 3)
    row = mh.sketches(documents(prepared, [(1, words(50, 1))]), 5).first()
    kept = np.frombuffer(bytes(row["signature"]), "<u2")
    assert row["buckets"] == mh.bucket_keys(kept).view(np.int64).tolist()


def test_words_are_split_as_defined():
    assert len(mh.shingles("A b\x85c É a", 1)) == 3  # no-break space and next line part no words
    assert (mh.shingles("ONE two", 5) == mh.shingles("one\x0bTWO", 5)).all()
    assert len(mh.shingles("É é", 1)) == 2  # only A-Z are lower-cased
    assert len(mh.shingles("ab c", 2)) == 1 and (mh.shingles("ab c", 2) != mh.shingles("a bc", 2)).all()


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(0)
    pool = np.unique(draw.integers(0, 1 << 63, 3000, np.uint64))
    a, b = pool[:2000], pool[500:2500]
    agree = (mh.signature(a) == mh.signature(b)).mean()
    assert abs(agree - 1500 / 2500) < 0.15


def test_lower_similarities_are_refused(edges):
    with pytest.raises(ValueError):
        mh.near_duplicates(edges, 4, percent=50)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-9, 30), st.integers(-9, 30)), min_size=1, max_size=40))
def test_components(prepared, links):
    df = prepared.createDataFrame(links, "u long, v long")
    found = {r["node"]: r["component"] for r in components(df).collect()}
    links = [x for x in links if x[0] != x[1]]
    assert found == least_reachable({n for x in links for n in x}, links)


def test_components_of_a_long_path_and_a_star(prepared):
    path = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1001 + i) for i in range(500)]
    df = prepared.createDataFrame(path + star, "u long, v long")
    found = {r["node"]: r["component"] for r in components(df).collect()}
    assert found == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1501)}}
