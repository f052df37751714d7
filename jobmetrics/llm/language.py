"""Languages of documents as mixtures, by expectation-maximisation.

Each language is a distribution over hashed character trigrams, learned from labelled documents.
A document's trigrams are taken as drawn from a mixture of the languages; its proportions are
found by expectation-maximisation. How many languages it has is decided by likelihood less a
penalty for each: languages are added in the order of their proportions while that pays.

Proportions of the languages learned sum to 1 even for a text in none of them. Whether it is in
one is told by a background component, which has all hashed trigrams alike: it takes the trigrams
that no language learned accounts for.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from jobmetrics.llm.common import Batches, code_points, map_rows, may_be_sampled, whole_text

# Learning sees at most this many documents of each language.
SAMPLE_PER_LANGUAGE = 2_000
BUCKETS = 1 << 14
SMOOTHING = 0.1
STEPS = 12
# Neighbouring trigrams share characters, so a text tells as much as a third of them would.
OVERLAP = 3
PENALTY = 6.0
# A text of which the background has more than the first, and each language learned less than the
# second, is in none of them. On sf0.1, of texts in a language left out of learning the background
# has a median of 0.39 to 0.68 and the nearest language one of 0.25 to 0.33; of 99 % of texts in
# those learned the background has at most 0.006. A passage of nearly half a text may so be in an
# unknown language.
MOST_BACKGROUND = 0.25
LEAST_LANGUAGE = 0.5
UNDETERMINED = "und"
MIXTURE = "lang string, proportion double, score double, languages string"

LETTER = np.array([chr(c).isalpha() for c in range(0x110000)])


def trigrams(text: str) -> np.ndarray:
    """Hashes of the trigrams of a text's lower-cased letters, runs of others counting as one space."""
    codes = code_points(text.lower())
    letter = LETTER[codes]
    if not letter.any():
        return np.zeros(0, np.int64)
    after_letter = np.concatenate([[False], letter[:-1]])
    codes = np.where(letter, codes, 32)[letter | after_letter].astype(np.uint64)
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint64) if codes[-1] != 32 else np.concatenate(
        [[32], codes]).astype(np.uint64)
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    mixed = codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) \
        + codes[2:] * np.uint64(0x165667B19E3779F9)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(50)).astype(np.int64)


@dataclass(frozen=True)
class Languages:
    """Names in alphabetical order, and for each the probabilities of the hashed trigrams.

    ``unseen`` is for each the share of trigrams in a further text that learning has not met.
    """

    names: tuple[str, ...]
    probability: np.ndarray
    unseen: tuple[float, ...] = ()

    def mixture(self, text: str) -> tuple[str, float, float, str]:
        """(lang, its proportion, score, all languages found); see ``with_language``."""
        found = trigrams(text)
        if not len(found) or not self.names:
            return UNDETERMINED, 0.0, 0.0, ""
        counts = np.bincount(found, minlength=BUCKETS)
        seen = np.flatnonzero(counts)
        n, p = counts[seen].astype(float), self.probability[:, seen]
        alone = np.log(p) @ n
        shares = proportions(p, n)
        order = np.lexsort((-alone, -shares))
        first = int(np.argmax(alone))
        chosen, weight, likelihood = [first], np.ones(1), alone[first]
        least = OVERLAP * PENALTY * np.log(max(n.sum() / OVERLAP, np.e))
        for other in order:
            if other == first:
                continue
            if shares[other] * n.sum() * np.log(1 / p.min()) < least:
                break  # its trigrams are too few to pay for it, however unlikely without it
            attempt = [*chosen, int(other)]
            w = proportions(p[attempt], n)
            with_it = float(np.log(w @ p[attempt]) @ n)
            if with_it - likelihood <= least:
                break
            chosen, weight, likelihood = attempt, w, with_it
        best = int(np.argmax(weight))
        rivals = (alone - alone[chosen[best]]) / OVERLAP
        rivals[chosen] = np.where(np.arange(len(chosen)) == best, 0.0, -np.inf)
        sure = 1 / np.exp(np.clip(rivals, -700, 700)).sum()
        listed = " ".join(f"{self.names[k]}:{s:.3f}" for k, s in sorted(zip(chosen, weight), key=lambda x: -x[1]))
        return self.names[chosen[best]], float(weight[best]), float(min(1.0, sure * weight[best])), listed

    def is_known(self, text: str) -> bool:
        """Whether a text is in the languages learned; see ``in_known_language``."""
        found = trigrams(text)
        if not len(found) or not self.names:
            return False
        counts = np.bincount(found, minlength=BUCKETS)
        seen = np.flatnonzero(counts)
        n, p = counts[seen].astype(float), self.probability[:, seen]
        q = np.vstack([p, np.full(len(seen), 1 / BUCKETS)])
        w = proportions(q, n)
        main = int(np.argmax(w[:-1]))
        if w[main] >= LEAST_LANGUAGE or w[-1] <= MOST_BACKGROUND + (self.unseen[main] if self.unseen else 0.0):
            return True
        gain = float(np.log(w @ q) @ n - np.log(proportions(p, n) @ p) @ n)
        return gain <= OVERLAP * PENALTY * np.log(max(n.sum() / OVERLAP, np.e))


def proportions(p: np.ndarray, n: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Mixture weights of the rows of ``p`` for counts ``n``, by expectation-maximisation."""
    w = np.full(len(p), 1 / len(p))
    if len(p) == 1:
        return w
    total = n.sum()
    for _ in range(steps):
        w = w * (p @ (n / (w @ p))) / total
    return w


def learn(docs: DataFrame, learnable: Column, per_language: int = SAMPLE_PER_LANGUAGE) -> Languages:
    """Trigram distributions from the rows with a language for which ``learnable`` holds.

    At most ``per_language`` documents of each language, those whose ids have the lowest hashes,
    are read whole. What reaches the driver are BUCKETS counts for each language.
    """
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    usable = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
              .where(learnable & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()))
    # One row a language, and at most per_language ids of each: less than the model itself, which
    # every task gets too.
    counts = usable.groupBy("lang").agg(F.count("*").alias("total"))
    ids = (usable.join(F.broadcast(counts), "lang").where(may_be_sampled(F.xxhash64("doc_id"), F.col("total"), per_language))
           .withColumn("rank", rank).where(F.col("rank") <= per_language).select("doc_id", "lang"))
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                         whole_text().alias("text")).join(F.broadcast(ids), ["doc_id", "lang"]).select("lang", "text"))

    def count(batches: Batches) -> Iterable[list[tuple]]:
        counts: dict[str, np.ndarray] = {}
        for rows in batches:
            for lang, text in rows:
                counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                counts[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, found in counts.items():
            yield [(lang, int(k), int(found[k])) for k in np.flatnonzero(found)]

    summed = (map_rows(texts, count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect())
    names = tuple(sorted({row["lang"] for row in summed}))
    table = np.full((len(names), BUCKETS), SMOOTHING)
    for row in summed:
        table[names.index(row["lang"]), row["bucket"]] += row["n"]
    # What was met once tells how much was not met.
    once = np.isclose(table, 1 + SMOOTHING).sum(1) / np.maximum((table - SMOOTHING).sum(1), 1)
    return Languages(names, table / table.sum(1, keepdims=True) if names else table, tuple(once.tolist()))


def mixture(languages: Languages, text: Column) -> Column:
    """The mixture of a text column without nulls, as a struct MIXTURE."""
    @F.pandas_udf(MIXTURE)
    def inferred(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in MIXTURE.split(", ")]
        for texts in batches:
            yield pd.DataFrame([languages.mixture(t) for t in texts], columns=names)

    return inferred(text)


def with_language(docs: DataFrame, languages: Languages, out: str = "mixture") -> DataFrame:
    """``docs`` with the struct ``out``: the main language, its proportion, a score, all languages.

    ``lang`` is ``und``, with score 0, for null text and text without a letter, or if no language
    was learned. The score is the proportion times the probability that no other language alone
    explains the text better. No row is lost.
    """
    return docs.withColumn(out, mixture(languages, whole_text()))


def in_known_language(languages: Languages, text: Column) -> Column:
    """Whether a text column without nulls is in the languages learned, one or several of them.

    It is not if the main language has less than LEAST_LANGUAGE of it and the background more than
    MOST_BACKGROUND, beyond what that language has of trigrams not met in learning, and if that pays
    as a further language must: texts too short to tell are known. Without a letter, or without a
    language learned, no text is.
    """
    @F.pandas_udf("boolean")
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([languages.is_known(t) for t in texts], dtype=bool)

    return known(text)
