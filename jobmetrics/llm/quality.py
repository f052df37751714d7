"""Quality scores by Bradley-Terry ranking of documents.

A document is described by how often one kind of character follows another, and by how much its
words and lines repeat. Weights are learned from pairs of a document labelled good and one
labelled bad: the logistic loss of the difference of their features is least where the good one
ranks above the bad one most often. The scores so learned only rank; the threshold is the
quantile that leaves as large a share below it as documents were labelled bad. It lies at 0.7 of
the final score.

All labelled documents are learned from. They are dealt into blocks by a hash, and every good one of a block is
paired with every bad one of it, so that the pairs grow as the documents do. A step of Newton's method is one pass
over the blocks that adds up gradient and curvature; the quantile is found exactly, by counting ranks in ever narrower bins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from jobmetrics.llm.common import Batches, code_points, map_rows, stored, whole_text

# Documents of a block, about: of the rarer label, and of the other one.
FEW, MANY = 32, 256
# Goods whose pairs with a block's bads are held at once.
PAIRED = 512
BINS = 1024
THRESHOLD = 0.7
RIDGE = 1e-3
NEWTON_STEPS = 12
STILL = 1e-8

# Kinds of characters: letters by case, digits, space, line end, some signs each by itself, others.
SIGNS = ".,;:!?'\"-()|#%&$*@/\\<>=+_[]{}~^"
LOWER, UPPER, OTHER_LETTER, DIGIT, SPACE, LINE_END, CONTROL, OTHER = range(8)
KINDS = 8 + len(SIGNS)


def _kind(char: str) -> int:
    if char in SIGNS:
        return 8 + SIGNS.index(char)
    if char == "\n":
        return LINE_END
    if char.isspace():
        return SPACE
    if char.islower():
        return LOWER
    if char.isupper():
        return UPPER
    if char.isalpha():
        return OTHER_LETTER
    if char.isdigit():
        return DIGIT
    return CONTROL if not char.isprintable() else OTHER


KIND_OF = np.array([_kind(chr(c)) for c in range(0x3000)], np.uint16)
# Signs come in many kinds; pairs are counted among these coarser ones and all kinds by themselves.
COARSE = 12
COARSE_OF = np.array([*range(8), *[8 if s in ".,;:'\"-()?" else 9 if s == "!" else 10 if s == "|" else 11
                                   for s in SIGNS]], np.uint16)
FEATURES = KINDS + COARSE * COARSE + 8


def features(text: str) -> np.ndarray:
    """The description of a text; all zero but the last for one without characters."""
    out = np.zeros(FEATURES)
    n = len(text)
    if not n:
        out[-1] = 1.0
        return out
    codes = code_points(text)
    kinds = np.where(codes < len(KIND_OF), KIND_OF[np.minimum(codes, len(KIND_OF) - 1)], OTHER_LETTER)
    out[:KINDS] = np.sqrt(np.bincount(kinds, minlength=KINDS) / n)
    coarse = COARSE_OF[kinds]
    follows = np.bincount(coarse[:-1] * COARSE + coarse[1:], minlength=COARSE * COARSE)
    out[KINDS:KINDS + COARSE * COARSE] = np.sqrt(follows / n)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n_words, n_lines = max(len(words), 1), max(len(lines), 1)
    distinct = len(set(words))
    out[-8:-1] = (
        np.log1p(n) / 10, np.log1p(n_words) / 10, np.sqrt(n / n_words) / 5, np.log1p(n / n_lines) / 10,
        distinct / n_words, np.log1p(distinct) / np.log1p(n_words), len(set(lines)) / n_lines,
    )
    return out


@dataclass(frozen=True)
class Ranking:
    """Weights on standardized features, and the rank score at the threshold."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def rank(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, THRESHOLD where the rank equals the threshold's."""
        above = np.clip(self.rank(x) - self.threshold + np.log(THRESHOLD / (1 - THRESHOLD)), -500, 500)
        return 1 / (1 + np.exp(-above))


def pair_sums(good: np.ndarray, bad: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Descent and curvature of the loss, added up over all pairs of a good and a bad row."""
    descent, curve = np.zeros(len(weights)), np.zeros((len(weights), len(weights)))
    for at in range(0, len(good) if len(bad) else 0, PAIRED):
        some = good[at:at + PAIRED]
        wrong = 1 / (1 + np.exp(np.clip((some @ weights)[:, None] - (bad @ weights)[None, :], -30, 30)))
        bent = wrong * (1 - wrong)
        descent += wrong.sum(1) @ some - wrong.sum(0) @ bad
        both = some.T @ (bent @ bad)
        curve += (some * bent.sum(1)[:, None]).T @ some + (bad * bent.sum(0)[:, None]).T @ bad - both - both.T
    return descent, curve


def newton(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], pairs: int) -> np.ndarray:
    """Bradley-Terry weights: where the mean loss of the pairs, with a ridge, is least."""
    weights = np.zeros(FEATURES)
    for _ in range(NEWTON_STEPS):
        descent, curve = sums(weights)
        step = np.linalg.solve(curve / pairs + RIDGE * np.eye(FEATURES), descent / pairs - RIDGE * weights)
        weights = weights + step
        if np.abs(step).max() < STILL:
            break
    # The order of addition decides the last digits.
    return np.round(weights, 9)


def _without_pairs(n_bad: int) -> Ranking:
    """Nothing ranks above anything else, and all documents are as good as the kind there is."""
    return Ranking(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 1.0 if n_bad else -1.0)


def _spread(deviation: np.ndarray) -> np.ndarray:
    return np.where(deviation < 1e-6, 1.0, deviation)


def fit_ranking(good: np.ndarray, bad: np.ndarray, share_bad: float) -> Ranking:
    """A ranking from all pairs of rows of features that one task can hold; ``learn`` is for tables."""
    if not len(good) or not len(bad):
        return _without_pairs(len(bad))
    both = np.concatenate([good, bad])
    mean, scale = both.mean(0), _spread(both.std(0))
    weights = newton(lambda w: pair_sums(good / scale, bad / scale, w), len(good) * len(bad))
    ranking = Ranking(mean, scale, weights, 0.0)
    return Ranking(mean, scale, weights, quantile(ranking.rank(good), ranking.rank(bad), share_bad))


def quantile(good: np.ndarray, bad: np.ndarray, share_bad: float) -> float:
    """The rank with ``share_bad`` of all documents below, midway between two neighbours there."""
    ranks = np.concatenate([good, bad])
    weight = np.concatenate([np.full(len(good), (1 - share_bad) / len(good)), np.full(len(bad), share_bad / len(bad))])
    order = np.argsort(ranks, kind="stable")
    ranks, below = ranks[order], np.cumsum(weight[order])
    at = min(int(np.searchsorted(below, share_bad - 1e-9)), len(ranks) - 2)
    return float((ranks[at] + ranks[at + 1]) / 2)


def _in_blocks(described: DataFrame, n_good: int, n_bad: int) -> DataFrame:
    """One row a block: features of its goods and bads. Rows of the rarer label are in all ``part``s that share them."""
    blocks = max(1, min(n_good, n_bad) // FEW)
    parts = -(-max(n_good, n_bad) // (blocks * MANY))
    rare = F.col("label") == int(n_good <= n_bad)
    part = F.when(rare, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(
        F.array(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(parts)).cast("int")))
    dealt = described.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks))).withColumn("part", F.explode(part))

    def pack(rows: pa.Table) -> pa.Table:
        labels, x = rows.column("label").to_pylist(), rows.column("x").to_pylist()
        good, bad = (b"".join(sorted(v for v, label in zip(x, labels) if label == k)) for k in (1, 0))
        return pa.table({"part": pa.array([rows.column("part")[0].as_py()], pa.int32()), "good": pa.array([good], pa.binary()),
                         "bad": pa.array([bad], pa.binary())})

    return dealt.groupBy("block", "part").applyInArrow(pack, "part int, good binary, bad binary")


def _rows(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<f4").reshape(-1, FEATURES).astype(float)


def _added(rows: DataFrame, of_row: Callable[..., np.ndarray]) -> np.ndarray:
    """The sum over all rows of an array for each: a task's first, then those of all tasks in one."""

    def total(arrays: Iterable[np.ndarray]) -> list[tuple]:
        sums = None
        for array in arrays:
            sums = array if sums is None else sums + array
        return [] if sums is None else [(sums.tobytes(),)]

    def of_task(batches: Batches) -> Iterator[list[tuple]]:
        yield total(of_row(*row) for batch in batches for row in batch)

    def of_all(batches: Batches) -> Iterator[list[tuple]]:
        yield total(np.frombuffer(array) for batch in batches for (array,) in batch)

    return np.frombuffer(map_rows(map_rows(rows, of_task, "sums binary").repartition(1), of_all, "sums binary").collect()[0]["sums"])


def _once(part: int, good: bytes, bad: bytes, rare: int) -> tuple[np.ndarray, np.ndarray]:
    """Goods and bads of a block without those that another part has as well."""
    return tuple(_rows(data if part == 0 or label != rare else b"") for label, data in ((1, good), (0, bad)))


def quantile_of(ranks: DataFrame, n_good: int, n_bad: int, share_bad: float) -> float:
    """``quantile`` of a table of ``label`` and ``rank``, exactly: bins get narrower until one value is left."""
    weight = {1: (1 - share_bad) / n_good, 0: share_bad / n_bad}
    ends = ranks.agg(F.min("rank").alias("low"), F.max("rank").alias("high")).first()
    low, high, before = ends["low"], ends["high"], 0.0
    within = ranks
    while True:
        width = max(high - low, 1e-300)
        at = F.least(F.floor((F.col("rank") - low) / width * BINS), F.lit(BINS - 1))
        bins = within.groupBy(at.alias("bin")).agg(
            F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad"), F.min("rank").alias("low"),
            F.max("rank").alias("high"))
        counted = sorted(bins.collect(), key=lambda r: r["bin"])
        for found in counted:
            after = before + found["good"] * weight[1] + found["bad"] * weight[0]
            if after >= share_bad - 1e-9 or found is counted[-1]:
                break
            before = after
        low, high = found["low"], found["high"]
        within = ranks.where(F.col("rank").between(low, high))
        if low == high:
            break
    # Where the share is reached before the last of equal ranks, the next one is equal.
    last = weight[0] if found["bad"] else weight[1]
    above = ranks.where(F.col("rank") > low).agg(F.min("rank")).first()[0]
    if above is None:
        if found["good"] + found["bad"] > 1:
            return float(low)
        above = ranks.where(F.col("rank") < low).agg(F.max("rank")).first()[0]
        return float(low if above is None else (low + above) / 2)
    return float(low if after - last >= share_bad - 1e-9 else (low + above) / 2)


def learn(docs: DataFrame, labels: DataFrame, learnable: Column) -> Ranking:
    """A ranking from all labelled rows for which ``learnable``, a condition on doc_id, holds, and their whole texts.

    The share of bad documents is that of all learnable labels. Null labels and ids teach nothing.
    """
    usable = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
              .where(learnable & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)))
    counts = {row["label"]: row["count"] for row in usable.groupBy("label").count().collect()}
    total = sum(counts.values())
    share_bad = counts.get(0, 0) / total if total else 0.0
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).where(
        learnable & F.col("doc_id").isNotNull())
    there = {row["label"]: row["count"] for row in known.select("doc_id").join(usable, "doc_id").groupBy("label").count().collect()}
    n_good, n_bad = there.get(1, 0), there.get(0, 0)
    if not n_good or not n_bad:
        return _without_pairs(n_bad)

    def describe(batches: Batches) -> Iterator[list[tuple]]:
        for rows in batches:
            yield [(doc_id, features(text).astype("<f4").tobytes()) for doc_id, text in rows]

    # Described before they are joined, so that no text is sent.
    described = map_rows(known, describe, "doc_id long, x binary").join(usable, "doc_id")
    blocks, rare = stored(_in_blocks(described, n_good, n_bad), "quality-blocks"), int(n_good <= n_bad)

    def moments(part: int, good: bytes, bad: bytes) -> np.ndarray:
        both = np.concatenate(_once(part, good, bad, rare))
        pairs = len(good) // (4 * FEATURES) * (len(bad) // (4 * FEATURES))
        return np.concatenate([both.sum(0), (both ** 2).sum(0), [float(pairs)]])

    sums = _added(blocks, moments)
    mean = sums[:FEATURES] / (n_good + n_bad)
    scale = _spread(np.sqrt(np.maximum(sums[FEATURES:2 * FEATURES] / (n_good + n_bad) - mean ** 2, 0.0)))

    def step(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def of_block(part: int, good: bytes, bad: bytes) -> np.ndarray:
            descent, curve = pair_sums(_rows(good) / scale, _rows(bad) / scale, weights)
            return np.concatenate([descent, curve.ravel()])

        found = _added(blocks, of_block)
        return found[:FEATURES], found[FEATURES:].reshape(FEATURES, FEATURES)

    weights = newton(step, int(sums[-1]))
    ranking = Ranking(mean, scale, weights, 0.0)

    def ranked(batches: Batches) -> Iterator[list[tuple]]:
        for rows in batches:
            for row in rows:
                yield [(label, float(r)) for label, x in zip((1, 0), _once(*row, rare)) for r in ranking.rank(x)]

    ranks = stored(map_rows(blocks, ranked, "label int, rank double"), "quality-ranks")
    return Ranking(mean, scale, weights, quantile_of(ranks, n_good, n_bad, share_bad))


def score(ranking: Ranking, text: Column) -> Column:
    """The score of a text column without nulls, as a column expression."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(ranking.score(np.array([features(t) for t in texts]).reshape(-1, FEATURES)))

    return scored(text)


def with_score(docs: DataFrame, ranking: Ranking, out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text; null text counts as empty. No row is lost."""
    return docs.withColumn(out, score(ranking, whole_text()))


def is_good(column: str = "score") -> Column:
    return F.col(column) >= THRESHOLD
