"""Toxic spans and document scores by a linear-chain conditional random field.

Labels are given for documents. A token of a toxic document is labelled toxic if its word, or a
beginning of it, occurs in toxic documents far more often than chance allows; tokens of clean
documents are clean. A two-state conditional random field is trained on lines so labelled. For
any text, forward-backward gives each token's probability of being toxic. Tokens of at least
one half make the offending spans; how many they are expected to be, and the surest of them,
give the document's score through a logistic function fitted to the documents' labels.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from heapq import nsmallest
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from jobmetrics.llm.common import Batches, bounded_sample, crc, map_rows, stored, whole_text
from jobmetrics.llm.minhash import shingles, signature

# Learning sees at most this many documents of each label, and of each of them this many lines, cut to this
# many tokens, from anywhere in the text.
SAMPLE_PER_LABEL, LINES_PER_DOCUMENT, LINE_TOKENS = 3_000, 2, 64
# A feature marks toxic tokens if chance would give its counts with a probability below e^-14
# (about one in a million), and it is this many times as frequent among toxic documents.
SURPRISE, RATIO = 14.0, 4
WEIGHTS = 1 << 18
STEPS, RATE, RIDGE = 40, 0.5, 1e-5
WORDS_KEPT = 300_000
THRESHOLD = 0.7
# Documents that share one of so many hash minima are compared when looking for copies in what teaches.
MINIMA = 4
# Share of equal minima from which a document is a near copy.
COPY = 0.7
# Marginals below this are not summed: a long clean text has very many of them.
DOUBT = 0.2
EVIDENCE = 4
RESULT = "score double, spans string"

TOKEN = re.compile(r"[^\W_]+|\n")


def marks(word: str) -> list[str]:
    """What may mark a word as toxic: itself and its beginnings."""
    word = word.lower()
    return [word, *(f"{word[:k]}-" for k in (4, 5, 6, 7, 8) if len(word) > k)]


def feature_ids(word: str) -> list[int]:
    """Numbers of a word's features: its marks, its end, its length and one that all words have."""
    word = word.lower()
    names = [*marks(word), f"-{word[-3:]}", f"#{min(len(word), 12)}", "*"]
    return [zlib.crc32(n.encode()) % WEIGHTS for n in names]


def log_odds(before: np.ndarray, from_clean: tuple[float, float], from_toxic: tuple[float, float]) -> np.ndarray:
    """The log-odds of two states after a transition, from those before it.

    ``from_clean`` and ``from_toxic`` are the transition scores (to clean, to toxic).
    """
    to_toxic = np.logaddexp(from_clean[1], from_toxic[1] + before)
    return to_toxic - np.logaddexp(from_clean[0], from_toxic[0] + before)


def forward_backward(emission: np.ndarray, starts: np.ndarray, lengths: np.ndarray, start: float,
                     transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of toxic for each token by what comes up to it, and by what comes after it.

    Sequences lie one after the other in ``emission``; all of them advance together, the longest
    taking the most steps.
    """
    forward, backward = emission.astype(float), np.zeros(len(emission))
    order = np.argsort(-lengths, kind="stable")
    first, length = starts[order], lengths[order]
    running = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), "left")
    clean, toxic = tuple(transition[0]), tuple(transition[1])
    back_clean, back_toxic = (transition[0, 0], transition[1, 0]), (transition[0, 1], transition[1, 1])
    for t, n in enumerate(running):
        at = first[:n] + t
        forward[at] += start if t == 0 else log_odds(forward[at - 1], clean, toxic)
    for t, n in enumerate(running):
        if t:
            at = first[:n] + length[:n] - 1 - t
            backward[at] = log_odds(emission[at + 1] + backward[at + 1], back_clean, back_toxic)
    return forward, backward


def sigmoid(x: np.ndarray | float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass
class Field:
    """The random field, and the logistic function from its marginals to document scores."""

    weights: np.ndarray
    start: float
    transition: np.ndarray
    scale: np.ndarray
    known: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "known": {}}

    def word_score(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            found = float(self.weights[feature_ids(word)].sum())
            if len(self.known) < WORDS_KEPT:
                self.known[word] = found
        return found

    def marginals(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the probability of toxic of each of its tokens; 0 for line ends."""
        tokens = [TOKEN.findall(t) for t in texts]
        ends = np.cumsum([len(t) for t in tokens])
        flat = [w for t in tokens for w in t]
        breaks = np.array([w == "\n" for w in flat], bool)
        emission = np.array([0.0 if w == "\n" else self.word_score(w) for w in flat])
        result = np.zeros(len(flat))
        cuts = np.unique(np.concatenate([[0], np.flatnonzero(breaks), np.flatnonzero(breaks) + 1, ends]))
        cuts = cuts[cuts <= len(flat)]
        starts, lengths = cuts[:-1], np.diff(cuts)
        lines = ~breaks[starts] if len(starts) else np.zeros(0, bool)
        forward, backward = forward_backward(emission, starts[lines], lengths[lines], self.start, self.transition)
        result = np.where(breaks, 0.0, sigmoid(forward + backward))
        return np.split(result, ends[:-1]) if len(texts) else []

    def evidence(self, marginals: np.ndarray) -> np.ndarray:
        """What a document's score is made from: how many toxic tokens to expect, the surest, their share."""
        expected = marginals[marginals >= DOUBT].sum()
        return np.array([np.log1p(expected), marginals.max(initial=0.0),
                         np.sqrt(expected / max(len(marginals), 1)), 1.0])

    def scores(self, texts: list[str]) -> list[tuple[float, str]]:
        """(score, spans as "start-end" in code points) of each text."""
        out = []
        for text, p in zip(texts, self.marginals(texts)):
            spans = ""
            if (p >= 0.5).any():
                spans = " ".join(f"{a}-{b}" for a, b in toxic_spans(text, p))
            out.append((float(sigmoid(self.evidence(p) @ self.scale)), spans))
        return out


def toxic_spans(text: str, marginals: np.ndarray) -> list[tuple[int, int]]:
    """Runs of toxic tokens as (start, end) in the text."""
    spans: list[list[int]] = []
    was_toxic = False
    for token, p in zip(TOKEN.finditer(text), marginals):
        if p >= 0.5 and was_toxic:
            spans[-1][1] = token.end()
        elif p >= 0.5:
            spans.append([token.start(), token.end()])
        was_toxic = p >= 0.5
    return [(a, b) for a, b in spans]


def train(lines: list[tuple[list[str], list[int]]]) -> Field:
    """Weights that maximise the likelihood of labelled lines: (words, 0 or 1 for each)."""
    ids = {w: feature_ids(w) for w in {w for words, _ in lines for w in words}}
    rows = np.array([i for words, _ in lines for w in words for i in ids[w]], np.int64)
    sizes = np.array([len(ids[w]) for words, _ in lines for w in words], np.int64)
    token = np.repeat(np.arange(len(sizes)), sizes)
    truth = np.array([y for _, labels in lines for y in labels], float)
    lengths = np.array([len(words) for words, _ in lines], np.int64)
    starts = np.cumsum(lengths) - lengths
    weights, start, transition = np.zeros(WEIGHTS), 0.0, np.zeros((2, 2))
    if not len(truth):
        return Field(weights, -4.0, transition, np.zeros(EVIDENCE))
    inside = np.ones(len(truth), bool)
    inside[starts] = False
    later = np.flatnonzero(inside)
    pairs = np.array([[((truth[later - 1] == a) & (truth[later] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    seen = [np.full(WEIGHTS, 1e-8), 1e-8, np.full((2, 2), 1e-8)]
    n = len(lines)
    for _ in range(STEPS):
        emission = np.bincount(token, weights[rows], len(truth))
        forward, backward = forward_backward(emission, starts, lengths, start, transition)
        p = sigmoid(forward + backward)
        g_weights = np.bincount(rows, (truth - p)[token], WEIGHTS) / n - RIDGE * weights
        g_start = float((truth - p)[starts].sum()) / n
        joint = [transition[a, b] + a * forward[later - 1] + b * (emission[later] + backward[later])
                 for a, b in ((0, 0), (0, 1), (1, 0), (1, 1))]
        joint = np.exp(np.array(joint) - np.logaddexp.reduce(joint, axis=0))
        g_transition = (pairs - joint.sum(1).reshape(2, 2)) / n - RIDGE * transition
        for k, g in enumerate((g_weights, g_start, g_transition)):
            seen[k] = seen[k] + g * g
        weights = weights + RATE * g_weights / np.sqrt(seen[0])
        start += RATE * g_start / np.sqrt(seen[1])
        transition = transition + RATE * g_transition / np.sqrt(seen[2])
    return Field(weights, start, transition, np.zeros(EVIDENCE))


def fit_scale(x: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """Logistic weights from evidence to label; documents count so that ``share`` are toxic."""
    scale = np.zeros(x.shape[1])
    if not len(x):
        return scale
    n_toxic = toxic.sum()
    weight = np.where(toxic > 0, share / max(n_toxic, 1), (1 - share) / max(len(x) - n_toxic, 1))
    ridge = 1e-4 * np.eye(x.shape[1])
    for _ in range(50):
        p = sigmoid(x @ scale)
        gradient = x.T @ (weight * (toxic - p)) - 1e-4 * scale
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        scale = scale + np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return scale


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, per_label: int = SAMPLE_PER_LABEL) -> Field:
    """A field from the labelled rows for which ``learnable``, a condition on doc_id, holds.

    It reads the whole texts of at most ``per_label`` documents of each label: marks are counted in all of them, the field
    learns from LINES_PER_DOCUMENT lines of each, chosen by a hash among all its lines. Null labels and ids teach nothing; without toxic documents every text gets a score of at most one half.
    """
    usable = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
              .where(learnable & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)))
    counts = {row["label"]: row["count"] for row in usable.groupBy("label").count().collect()}
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    chosen = bounded_sample(usable.where("label = 1"), per_label).union(
        bounded_sample(usable.where("label = 0"), per_label))
    # At most twice per_label rows, so they can be sent to every executor. Of rows with one id one teaches.
    sample = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
                    .join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]), "toxicity-sample")
    texts, n_clean, n_toxic = without_copies(sample)
    toxic_marks = surprising(texts, n_clean, n_toxic)
    lines = sorted((words.split(" "), list(map(int, flags))) for words, flags in
                   map_rows(texts, lambda batches: labelled_lines(batches, toxic_marks),
                            "words string, flags string").collect())
    model = train(lines)

    def evidence(batches: Batches) -> Iterator[list[tuple]]:
        for rows in batches:
            found = model.marginals([text for _, text in rows])
            yield [(label, *map(float, model.evidence(p))) for (label, _), p in zip(rows, found)]

    seen = np.array(sorted(map(tuple, map_rows(
        texts, evidence, "label int, count double, surest double, share double, one double").collect()))).reshape(-1, 1 + EVIDENCE)
    model.scale = fit_scale(seen[:, 1:], seen[:, 0], share)
    return model


def without_copies(sample: DataFrame) -> tuple[DataFrame, int, int]:
    """(label, text) of the documents that are no near copy of a kept one of the same label, and how many are clean and toxic.

    Near copies of one document would make any of its words look like a mark. They are looked for among those that share
    one of the first MINIMA hash minima, and told by the share of all minima that are equal. What reaches the driver
    is the signature of each document of the bounded sample.
    """

    def signatures(batches: Batches) -> Iterator[list[tuple]]:
        for rows in batches:
            sets = [shingles(text, 5) for _, _, text in rows]
            yield [(doc, label, signature(s).tolist() if len(s) else []) for (doc, label, _), s in zip(rows, sets)]

    found = map_rows(sample.select("doc_id", "label", "text"), signatures,
                     "doc_id long, label int, minima array<long>").collect()
    kept: dict[int, int] = {}
    sharing: dict[tuple, list[np.ndarray]] = {}
    for doc, label, minima in sorted(map(tuple, found)):
        signed = np.array(minima)
        keys = [(label, place, least) for place, least in enumerate(minima[:MINIMA])]
        if any((signed == other).mean() >= COPY for key in keys for other in sharing.get(key, ())):
            continue
        kept[doc] = label
        for key in keys:
            sharing.setdefault(key, []).append(signed)
    ids = sample.sparkSession.createDataFrame([(doc,) for doc in kept], "doc_id long")
    n_toxic = sum(kept.values())
    return sample.join(F.broadcast(ids), "doc_id").select("label", "text"), len(kept) - n_toxic, n_toxic


def surprising(texts: DataFrame, n_clean: int, n_toxic: int) -> frozenset[str]:
    """Marks that are in so many toxic documents, and so few clean ones, that it is no chance.

    Documents are counted by Spark, before and after a shuffle; only the marks found, of which
    there are few, reach the driver.
    """
    if not n_clean or not n_toxic:
        return frozenset()

    def count(batches: Batches) -> Iterable[list[tuple]]:
        for rows in batches:
            counts: dict[str, list[int]] = {}
            for label, text in rows:
                for mark in {m for word in set(TOKEN.findall(text)) if word != "\n" for m in marks(word)}:
                    counts.setdefault(mark, [0, 0])[label] += 1
            yield [(mark, *n) for mark, n in counts.items()]

    summed = (map_rows(texts, count, "mark string, clean long, toxic long")
              .groupBy("mark").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    in_toxic, in_clean = (F.col("toxic") + 0.01) / n_toxic, (F.col("clean") + 0.01) / n_clean
    everywhere = (F.col("toxic") + F.col("clean") + 0.02) / (n_toxic + n_clean)
    ratio = F.col("toxic") * F.log(in_toxic / everywhere) + F.col("clean") * F.log(in_clean / everywhere)
    found = summed.where((ratio > SURPRISE) & (in_toxic > RATIO * in_clean)).select("mark").collect()
    return frozenset(row["mark"] for row in found)


def labelled_lines(batches: Batches, toxic_marks: frozenset[str]) -> Iterator[list[tuple]]:
    """Lines to learn from: of toxic documents some with toxic tokens, of clean ones some at all, by a hash of the line."""
    for rows in batches:
        out = []
        for label, text in rows:
            found = []
            for at, line in enumerate(cut_lines(TOKEN.findall(text))):
                flags = [int(bool(label) and not toxic_marks.isdisjoint(marks(w))) for w in line]
                if any(flags) or not label:
                    joined = " ".join(line)
                    found.append((crc(joined.encode("utf-8", "surrogatepass")), at, joined, "".join(map(str, flags))))
            out += [(line, flags) for _, _, line, flags in nsmallest(LINES_PER_DOCUMENT, found)]
        yield out


def cut_lines(tokens: list[str]) -> Iterator[list[str]]:
    ends = [-1, *(i for i, t in enumerate(tokens) if t == "\n"), len(tokens)]
    for a, b in pairwise(ends):
        for at in range(a + 1, b, LINE_TOKENS):
            yield tokens[at:min(at + LINE_TOKENS, b)]


def toxicity(model: Field, text: Column) -> Column:
    """Score and spans of a text column without nulls, as a struct RESULT."""

    @F.pandas_udf(RESULT)
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(model.scores(list(texts)), columns=["score", "spans"])

    return scored(text)


def with_toxicity(docs: DataFrame, model: Field, out: str = "toxicity") -> DataFrame:
    """``docs`` with the struct ``out``: the score of each whole text and its offending spans.

    Null text counts as empty; a text without words has no span and the score of no evidence.
    No row is lost.
    """
    return docs.withColumn(out, toxicity(model, whole_text()))
