"""The pipeline stage by stage against what each stage's operator decides."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline as cp
import pytest
from llm_helpers import EDGES, edges, nothing, prepared  # noqa: F401
from oracle import compare
from pyspark.sql import functions as F
from test_minhash import expected
from test_packing import check

import __spark_entry__ as contract
from jobmetrics.llm import language, queries

SF = "/root/testdata/sf0.01"


def test_stages_one_after_the_other(prepared):
    docs = prepared.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in prepared.read.parquet(f"{SF}/labels.parquet").collect()}
    columns, before = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    for name, stage in cp.STAGES[:-1]:
        docs = cp.stored(stage(prepared, docs, SF), f"test-{name}")
        assert docs.columns == columns
        kept = {r["doc_id"]: r for r in docs.collect()}
        assert all(before[d] == r for d, r in kept.items())
        gone = set(before) - set(kept)
        if name == "quality":
            wrong = [d for d in gone if labels.get(d) == 1] + [d for d in kept if labels.get(d) == 0]
            assert gone and len(wrong) <= 0.03 * len(labels)
        elif name == "language":
            assert len(gone) <= 0.01 * len(before)
        else:
            want = expected([(d, r["text"]) for d, r in before.items()], 5)
            assert set(kept) == {row[0] for row in want if row[3]}
        before = kept
    rows = cp.STAGES[-1][1](prepared, docs, SF).collect()
    check(rows, [(d, r["text"]) for d, r in before.items()])


def test_edges(prepared, edges, nothing):
    for name, stage in cp.STAGES[:-1]:
        got = stage(prepared, edges, SF)
        assert got.columns == edges.columns
        rows = Counter(r["doc_id"] for r in got.collect())
        if name == "near-duplicates":
            assert rows == Counter({1: 1, 2: 1, 3: 1, 4: 1, 5: 1, None: 2, 7: 1, 8: 1, 9: 1, 10: 1, 11: 1})
        assert set(rows) <= {d for d, _ in EDGES}
        assert stage(prepared, nothing, SF).collect() == []


def test_registered():
    names = contract.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.queries()}
    assert set(queries.queries()) | {"pipeline"} <= set(names)
    assert set(contract.oracle_sql()) <= set(names)
    assert [n for n, _ in cp.STAGES] == ["quality", "language", "near-duplicates", "packing"]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_twin(prepared, name):
    path = SF.replace("0.01", "0.001")
    assert compare(prepared, path, queries.queries()[name], queries.oracle_sql()[name]) == []


FOREIGN = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem. ",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью. ",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki. ",
]


def test_texts_in_a_language_not_learned_go(prepared):
    docs = prepared.read.parquet(f"{SF}/documents.parquet")
    for left_out in ("es", "de"):
        learned = F.when(F.col("lang") != left_out, F.col("lang"))
        kept = {r["doc_id"] for r in cp.known_language(prepared, docs.withColumn("lang", learned), SF).collect()}
        rows = docs.where(F.length("text") > 300).select("doc_id", "lang").collect()
        foreign, known = ([r["doc_id"] in kept for r in rows if (r["lang"] == left_out) == k] for k in (True, False))
        assert len(foreign) > 50 and sum(foreign) <= 0.05 * len(foreign)
        assert sum(known) >= 0.99 * len(known)


def test_foreign_texts_go_and_foreign_passages_stay(prepared):
    docs = prepared.read.parquet(f"{SF}/documents.parquet")
    long = docs.where(F.length("text") > 600).orderBy("doc_id").limit(60).collect()
    texts = {10**9 + i: text * 5 for i, text in enumerate(FOREIGN)}
    mixed = {2 * 10**9 + i: r["text"][:600] + "\n" + (FOREIGN[i % 3] * 3)[:250] for i, r in enumerate(long)}
    added = [tuple({**long[0].asDict(), "doc_id": d, "text": t, "lang": None}.values()) for d, t in {**texts, **mixed}.items()]
    kept = cp.known_language(prepared, docs.union(prepared.createDataFrame(added, docs.schema)), SF)
    found = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert not found & set(texts)
    assert len(found & set(mixed)) >= len(mixed) - 1


def test_a_language_learned_from_little_stays(prepared):
    docs = prepared.read.parquet(f"{SF}/documents.parquet")
    few = docs.where("lang = 'fr'").orderBy("doc_id").limit(3).select("doc_id")
    ids = [r["doc_id"] for r in few.collect()]
    lang = F.when((F.col("lang") != "fr") | F.col("doc_id").isin(ids), F.col("lang"))
    languages = language.learn(docs.withColumn("lang", lang), F.lit(True))
    rows = docs.where("lang = 'fr'").withColumn("known", language.in_known_language(languages, F.col("text"))).collect()
    assert languages.unseen[languages.names.index("fr")] > 10 * max(u for n, u in zip(languages.names, languages.unseen) if n != "fr")
    assert sum(r["known"] for r in rows) >= 0.98 * len(rows)
