"""Language, quality and toxicity: held-out accuracy, and the models' parts by brute force."""

from __future__ import annotations

from itertools import product

import numpy as np
import pytest
from llm_helpers import EDGES, documents, edges, nothing, prepared, words  # noqa: F401
from pyspark.sql import functions as F

from jobmetrics.llm import language, quality, queries, toxicity
from jobmetrics.llm.common import held_out

SF = "/root/testdata/sf0.01"


def held_out_rows(prepared, name, label):
    found = queries.queries()[name](prepared, SF)
    labels = prepared.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col(label).alias("label"))
    assert found.count() == prepared.read.parquet(f"{SF}/documents.parquet").count()
    return found.where("held_out").join(labels, "doc_id").collect()


def area_under_curve(rows):
    good, bad = ([r["score"] for r in rows if r["label"] == k] for k in (1, 0))
    return np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])


# Language

def test_language_of_documents_held_out(prepared):
    found = queries.op2_language_mixture(prepared, SF)
    docs = prepared.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(docs, "doc_id").collect()
    assert len(rows) > 200
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) >= 0.98


def toy_languages():
    return language.Languages(("de", "fr"), np.array([
        language.SMOOTHING + np.bincount(language.trigrams(text), minlength=language.BUCKETS).astype(float)
        for text in ("der die das und nicht ein ist von sich mit dem auch " * 30,
                     "les des une dans est que pour qui sur pas avec il " * 30)]))


def normalized(languages):
    return language.Languages(languages.names, languages.probability / languages.probability.sum(1, keepdims=True))


def test_mixtures_have_the_right_proportions():
    languages = normalized(toy_languages())
    german, french = "der die das und nicht ein ist von " * 40, "les des une dans est que pour qui " * 40
    assert languages.mixture(german)[:2] == ("de", 1.0)
    lang, proportion, _, listed = languages.mixture(german + french)
    assert 0.4 < proportion < 0.6 and "de:" in listed and "fr:" in listed
    lang, proportion, _, _ = languages.mixture(german + french * 3)
    assert lang == "fr" and 0.65 < proportion < 0.85


def test_expectation_maximisation_climbs_to_the_best_mixture():
    draw = np.random.default_rng(0)
    p = draw.dirichlet(np.full(50, 0.3), 2) + 1e-6
    n = draw.multinomial(400, 0.3 * p[0] / p[0].sum() + 0.7 * p[1] / p[1].sum()).astype(float)
    w = language.proportions(p, n, 200)
    grid = np.linspace(0.001, 0.999, 999)
    best = grid[np.argmax([(np.log(g * p[0] + (1 - g) * p[1]) * n).sum() for g in grid])]
    assert abs(w[0] - best) < 2e-3 and abs(w.sum() - 1) < 1e-9


@pytest.mark.parametrize("text", ["", " ", "123 !!! \n", "😀"])
def test_texts_without_letters_are_undetermined(text):
    assert normalized(toy_languages()).mixture(text)[:3] == ("und", 0.0, 0.0)


def test_language_edges(edges, nothing):
    for learnable in (F.lit(True), F.lit(False)):
        languages = language.learn(edges, learnable)
        rows = language.with_language(edges, languages).select("doc_id", "mixture.*").collect()
        assert len(rows) == len(EDGES)
        assert all(0 <= r["score"] <= 1 and 0 <= r["proportion"] <= 1 for r in rows)
        assert {r["lang"] for r in rows if r["doc_id"] in (1, 2, 3, 7)} == {"und"}
    assert languages.names == ()
    assert language.with_language(nothing, language.learn(nothing, F.lit(True))).collect() == []


def test_the_label_is_no_input(prepared):
    docs = prepared.read.parquet(f"{SF}/documents.parquet").limit(300)
    languages = language.learn(docs, F.lit(True))
    other = docs.withColumn("lang", F.lit("xx"))
    both = [sorted(map(tuple, language.with_language(d, languages).select("doc_id", "mixture.*").collect()))
            for d in (docs, other)]
    assert both[0] == both[1]


# Quality

def test_quality_of_documents_held_out(prepared):
    rows = held_out_rows(prepared, "op4_quality_ranking", "quality")
    assert np.mean([r["predicted"] == r["label"] for r in rows]) >= 0.95
    assert area_under_curve(rows) >= 0.97
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_weights_rank_pairs_and_the_quantile_parts_them():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(800, quality.FEATURES))
    truth = draw.normal(size=quality.FEATURES)
    rank = x @ truth
    good, bad = x[rank > 0.5], x[rank < -0.5]
    model = quality.fit_ranking(good, bad, 0.25)
    s = np.concatenate([model.score(good), model.score(bad)])
    assert np.mean(model.score(good) >= 0.7) > 0.9 and np.mean(model.score(bad) < 0.7) > 0.9
    assert (s >= 0).all() and (s <= 1).all()


def test_weighted_quantile():
    assert quality.quantile(np.array([5.0, 6, 7]), np.array([1.0, 2]), 0.4) == 3.5
    assert quality.quantile(np.array([1.0]), np.array([1.0]), 0.5) == 1.0


@pytest.mark.parametrize("n_good, n_bad", [(700, 40), (60, 900), (1, 300)])
def test_quality_learns_from_every_labelled_document(prepared, monkeypatch, n_good, n_bad):
    """Each document is in pairs and among the ranks; no block has more than its share."""
    monkeypatch.setattr(quality, "FEW", 8)
    monkeypatch.setattr(quality, "MANY", 32)
    rows = [(i, int(i < n_good), np.full(quality.FEATURES, i, "<f4").tobytes()) for i in range(n_good + n_bad)]
    blocks = quality._in_blocks(prepared.createDataFrame(rows, "doc_id long, label int, x binary"), n_good, n_bad).collect()
    seen = [{int(v) for b in blocks for v in quality._rows(b[k])[:, 0] if b["good"] and b["bad"]} for k in ("good", "bad")]
    assert seen == [set(range(n_good)), set(range(n_good, n_good + n_bad))]
    once = [quality._once(b["part"], b["good"], b["bad"], int(n_good <= n_bad)) for b in blocks]
    assert sorted(int(v) for both in once for x in both for v in x[:, 0]) == list(range(n_good + n_bad))
    assert max(len(b[k]) for b in blocks for k in ("good", "bad")) < 100 * 4 * quality.FEATURES


def test_learned_ranking_is_that_of_the_blocks_pairs(prepared):
    """With one block for all, that of all pairs."""
    texts = [(i, "Plain words in a line. " * (i % 7 + 1) if i % 3 else "BUY !!! now %% " * (i % 5 + 1)) for i in range(60)]
    labels = prepared.createDataFrame([(i, int(i % 3 > 0 or i % 4 == 0), 0) for i, _ in texts], "doc_id long, quality int, toxic int")
    got = quality.learn(documents(prepared, texts), labels, F.lit(True))
    x = {k: np.array([quality.features(t).astype("<f4") for i, t in texts if int(i % 3 > 0 or i % 4 == 0) == k], float) for k in (0, 1)}
    want = quality.fit_ranking(x[1], x[0], len(x[0]) / 60)
    assert np.allclose(got.weights, want.weights, atol=1e-5) and abs(got.threshold - want.threshold) < 1e-5


@pytest.mark.parametrize("digits", [0, 1, 6])
def test_quantile_of_a_table_is_that_of_arrays(prepared, digits):
    draw = np.random.default_rng(digits)
    for n_good, n_bad, share in ((200, 100, 0.3), (3, 1, 0.25), (1, 1, 0.5), (50, 70, 0.99), (40, 2, 0.01)):
        good, bad = draw.normal(size=n_good).round(digits), draw.normal(size=n_bad).round(digits)
        ranks = prepared.createDataFrame([(1, float(v)) for v in good] + [(0, float(v)) for v in bad], "label int, rank double")
        got, want = quality.quantile_of(ranks, n_good, n_bad, share), quality.quantile(good, bad, share)
        # Equal ranks of both labels are counted in either order.
        ordered = np.unique(np.concatenate([good, bad]))
        assert got == want or (digits < 6 and abs(np.searchsorted(ordered, got) - np.searchsorted(ordered, want)) <= 1)


def test_quality_edges(prepared, edges, nothing):
    labels = prepared.createDataFrame([(4, 1, 0), (7, 0, 0), (7, None, None), (None, 1, 1), (5, 1, 1)],
                                      "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for some in (labels, none, labels.where("quality = 1"), labels.where("quality = 0")):
        ranking = quality.learn(edges, some, F.lit(True))
        rows = quality.with_score(edges, ranking, "found").select("doc_id", "found").collect()
        assert len(rows) == len(EDGES) and all(0 <= r["found"] <= 1 for r in rows)
    ranking = quality.learn(nothing, labels, F.lit(True))
    assert quality.with_score(nothing, ranking).collect() == []


# Toxicity

def test_toxicity_of_documents_held_out(prepared):
    rows = held_out_rows(prepared, "op10_toxic_spans", "toxic")
    assert np.mean([r["predicted"] == r["label"] for r in rows]) >= 0.95
    assert np.mean([not r["predicted"] for r in rows if not r["label"]]) >= 0.98


def test_forward_backward_by_enumeration():
    draw = np.random.default_rng(2)
    lengths = np.array([3, 1, 5])
    starts = np.cumsum(lengths) - lengths
    emission, transition, start = draw.normal(size=9), draw.normal(size=(2, 2)), 0.3
    forward, backward = toxicity.forward_backward(emission, starts, lengths, start, transition)
    got = toxicity.sigmoid(forward + backward)
    for at, n in zip(starts, lengths):
        weight = np.zeros((n, 2))
        for path in product((0, 1), repeat=int(n)):
            score = start * path[0] + sum(emission[at + t] * y for t, y in enumerate(path))
            score += sum(transition[a, b] for a, b in zip(path, path[1:]))
            for t, y in enumerate(path):
                weight[t, y] += np.exp(score)
        assert np.allclose(got[at:at + n], weight[:, 1] / weight.sum(1))


def test_training_raises_the_likelihood_of_labelled_tokens():
    lines = [(["you", "are", "foul", "foulest", "people"], [0, 0, 1, 1, 0]), (["nice", "people", "are"], [0, 0, 0])] * 20
    model = toxicity.train(lines)
    p = model.marginals(["you are foul\nnice people foulest"])[0]
    assert (p[[2, 6]] > 0.9).all() and (p[[0, 1, 3, 4, 5]] < 0.1).all()


def test_copies_of_a_document_teach_once(prepared):
    rows = [(i, 1, words(80, 5).replace("a", "b", i % 3)) for i in range(40)]
    rows += [(100 + i, i % 2, words(60, 100 + i) + (" foulword" if i % 2 else "")) for i in range(80)]
    sample = prepared.createDataFrame(rows, "doc_id long, label int, text string")
    texts, clean, toxic = toxicity.without_copies(sample)
    assert clean == 40 and 41 <= toxic <= 44 and texts.count() == clean + toxic
    assert "foulword" in toxicity.surprising(texts, clean, toxic)
    assert not {m for m in toxicity.surprising(texts, clean, toxic) if not m.startswith("foul")}


def test_a_shared_minimum_alone_makes_no_copy(prepared):
    """Half of the words are shared by all, so single minima agree often; and copies of a document of the other label teach."""
    shared = words(40, 1)
    rows = [(i, i % 2, f"{shared} {words(40, 100 + i)}") for i in range(30)] + [(100, 1, words(80, 5)), (101, 0, words(80, 5))]
    sample = prepared.createDataFrame(rows, "doc_id long, label int, text string")
    assert toxicity.without_copies(sample)[1:] == (16, 16)


def test_lines_to_learn_from_come_from_the_whole_text():
    texts = [(0, "\n".join(f"line {n} of {k}" for n in range(12))) for k in range(60)]
    out = next(toxicity.labelled_lines(iter([texts]), frozenset()))
    assert len(out) == 120 and {line.split()[1] for line, _ in out} == {str(n) for n in range(12)}
    marked = [(1, "\n".join(f"fine {n}" if n < 9 else f"foul {n}" for n in range(12)))]
    found = next(toxicity.labelled_lines(iter([marked]), frozenset(toxicity.marks("foul"))))
    assert len(found) == 2 and all(line.startswith("foul") and "1" in flags for line, flags in found)


def test_spans_are_offsets_in_the_text():
    text = "İ say: you FOUL, foul thing.\nfine"
    p = np.array([0, 0, 0, 0.9, 0.8, 0.1, 0, 0.6])
    assert [text[a:b] for a, b in toxicity.toxic_spans(text, p)] == ["FOUL, foul", "fine"]


def test_toxicity_edges(prepared, edges, nothing):
    labels = prepared.createDataFrame([(4, 1, 0), (7, 0, 1), (7, None, None), (None, 1, 1), (5, 1, 0)],
                                      "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0), labels.where("toxic = 1"), labels.where("toxic = 0")):
        model = toxicity.learn(edges, some, F.lit(True))
        rows = toxicity.with_toxicity(edges, model).select("doc_id", "toxicity.*").collect()
        assert len(rows) == len(EDGES) and all(0 <= r["score"] <= 1 for r in rows)
        assert {r["spans"] for r in rows if r["doc_id"] in (1, 2, 3)} == {""}
    assert toxicity.with_toxicity(nothing, toxicity.learn(nothing, labels, F.lit(True))).collect() == []


def test_folds(prepared):
    import zlib

    rows = prepared.createDataFrame([(i,) for i in [*range(50), None, -3]], "doc_id long").select(
        "doc_id", held_out("doc_id", 4, 2).alias("h")).collect()
    for r in rows:
        assert r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_documents_frame_has_clashing_names(prepared):
    assert {"score", "mixture"} <= set(documents(prepared, []).columns)
