"""The best documents for each of a set of items, found by descending two trees at once.

A document has a coordinate for each term: what the term adds to its score for any item that holds the term. So its
score for an item is the sum of its coordinates over the item's terms. Documents of a batch form a tree of groups of
similar ones, items another. A node holds the greatest of each coordinate below it: for items 1 where any of them
holds the term. The product of two nodes is no less than any score between them, so a pair of nodes whose
product stays below the weakest ``k``-th score of the items in it is left out with all that is below. What reaches
the leaves is scored exactly, in whole numbers.

1. Items are taken in blocks of a bounded number of terms. A pass over all documents counts the block's terms in each
   of them; these counts are stored, and give the number of documents, their mean length and those with a term.
2. One in ``SEEDS`` documents, by a hash of the id, is searched first: its ``k``-th best scores are a lower bound for
   those of all documents, from which every task starts.
3. All documents are searched. A task returns its ``k`` best for each item, of which Spark keeps the best.

Defined results: null texts hold no terms; a row is a document, also where ids repeat; equal scores come in the order of
ids, null ids last. Rows with one item_id, null included, are one item. Items without a term in any document give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from jobmetrics.llm.common import Batches, map_rows, stored, whole_text

# Terms of the items of a block, about; an item with more is a block of its own or with few others.
BLOCK_TERMS = 16_384
# Coordinates of a batch of documents that are held at once.
CELLS = 4 << 20
FAN_OUT = 8
SEEDS = 32
# Fixed values of the weighting.
LENGTH_SHARE, SATURATION, UNIT = 50, 20, 1_000_000_000

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c > 0x7F or 48 <= c <= 57 or 97 <= c <= 122 else 0x20 for c in range(256))
POSTINGS = "doc_id long, n long, terms binary, counts binary"
FOUND = "item long, doc_id long, score long"


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII digits and letters, these in lower case, and of all that is not ASCII."""
    return text.translate(_TABLE).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id`` and each of its distinct terms."""

    def run(batches: Batches) -> Iterable[list[tuple]]:
        for rows in batches:
            yield [(item, term) for item, text in rows for term in set(terms(text))]

    texts = items.select(F.col("item_id").cast("long").alias("item_id"), whole_text().cast("binary").alias("text"))
    return map_rows(texts, run, "item_id long, term binary").distinct()


def postings(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """For each document its number of terms, and which of the numbered ones it holds how often."""

    def run(batches: Batches) -> Iterable[list[tuple]]:
        for rows in batches:
            out = []
            for doc, text in rows:
                words = terms(text)
                held, counts = np.unique(np.array([i for i in map(numbers.get, words) if i is not None], np.int32), return_counts=True)
                out.append((doc, len(words), held.tobytes(), counts.astype(np.int32).tobytes()))
            yield out

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("text"))
    return map_rows(texts, run, POSTINGS)


def holding(counted: DataFrame) -> DataFrame:
    """In how many documents each term is, counted within tasks first."""

    def run(batches: Batches) -> Iterator[list[tuple]]:
        total = np.zeros(0, np.int64)
        for rows in batches:
            more = np.bincount(np.frombuffer(b"".join(r[0] for r in rows), np.int32))
            total = np.pad(total, (0, max(0, len(more) - len(total))))
            total[:len(more)] += more
        yield [(i, n) for i, n in enumerate(total.tolist()) if n]

    return map_rows(counted.select("terms"), run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def levels(members: np.ndarray, fan_out: int) -> list[np.ndarray]:
    """Greatest coordinates of each node of a tree over ``members`` (one a row), from the root's level down to the members."""
    found = [members]
    while len(found[0]) > fan_out:
        below = found[0]
        found.insert(0, np.maximum.reduceat(below, np.arange(0, len(below), fan_out)))
    return found


class ItemTree:
    """Items as rows of 0 and 1, similar ones side by side."""

    def __init__(self, held: list[np.ndarray], weights: np.ndarray) -> None:
        self.size, self.held = len(held), held
        # The items with the same weightiest term come together.
        self.order = sorted(range(self.size), key=lambda i: held[i][np.lexsort((held[i], -weights[held[i]]))].tolist())
        self.terms = np.zeros((self.size, len(weights)), bool)
        for place, item in enumerate(self.order):
            self.terms[place, held[item]] = True
        self.levels = levels(self.terms, FAN_OUT)

    def weakest(self, floors: np.ndarray) -> list[np.ndarray]:
        """The least floor below each node, level by level."""
        found = [floors[self.order]]
        while len(found) < len(self.levels):
            found.insert(0, np.minimum.reduceat(found[0], np.arange(0, len(found[0]), FAN_OUT)))
        return found


def children(nodes: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes one level down that belong to ``nodes``, and which of these each belongs to."""
    found = np.arange(below)
    owner = np.full(-(-below // FAN_OUT), -1)
    owner[nodes] = np.arange(len(nodes))
    owner = owner[found // FAN_OUT]
    return found[owner >= 0], owner[owner >= 0]


def reaching(items: ItemTree, docs: list[np.ndarray], active: np.ndarray, floors: np.ndarray) -> np.ndarray:
    """Pairs (place of an item, document) whose nodes all reach the floors; ``active`` are the columns of ``docs``."""
    weakest = items.weakest(floors)
    at = [0, 0]
    rows, columns = np.arange(len(items.levels[0])), np.arange(len(docs[0]))
    live = np.ones((len(rows), len(columns)), bool)
    while True:
        # Only nodes that are part of a live pair are multiplied.
        r, c = live.any(1), live.any(0)
        rows, columns, live = rows[r], columns[c], live[r][:, c]
        if not live.size:
            return np.zeros((0, 2), np.int64)
        bound = items.levels[at[0]][rows][:, active].astype(float) @ docs[at[1]][columns].T.astype(float)
        # Doubles hold such sums to within far less than the room given here.
        live &= bound * (1 + 1e-9) + 0.5 >= weakest[at[0]][rows][:, None]
        down = [at[0] + 1 < len(items.levels), at[1] + 1 < len(docs)]
        if not any(down):
            found = np.argwhere(live)
            return np.stack([rows[found[:, 0]], columns[found[:, 1]]], 1)
        if down[1]:
            at[1] += 1
            columns, owner = children(columns, len(docs[at[1]]))
            live = live[:, owner]
        if down[0] and (len(docs) - at[1] <= len(items.levels) - at[0]):
            at[0] += 1
            rows, owner = children(rows, len(items.levels[at[0]]))
            live = live[owner]


class Best:
    """The ``k`` best documents of each item so far."""

    def __init__(self, size: int, k: int, floors: np.ndarray) -> None:
        self.k, self.floors = k, np.maximum(floors, 1)
        self.found = [np.zeros((0, 3), np.int64) for _ in range(size)]

    def add(self, item: int, scores: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        enough = scores >= self.floors[item]
        rows = np.concatenate([self.found[item], np.stack([scores, missing, ids], 1)[enough]])
        if len(rows) > self.k:
            rows = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))[:self.k]]
            self.floors[item] = rows[-1, 0]
        elif len(rows) == self.k:
            self.floors[item] = max(self.floors[item], rows[:, 0].min())
        self.found[item] = rows

    def rows(self) -> Iterator[list[tuple]]:
        for item, rows in enumerate(self.found):
            if len(rows):
                yield [(item, None if missing else doc, score) for score, missing, doc in rows.tolist()]


def _search_batch(rows: list[tuple], items: ItemTree, weights: np.ndarray, documents: int, length: int, best: Best) -> None:
    held = np.frombuffer(b"".join(r[2] for r in rows), np.int32)
    if not len(held):
        return
    counts = np.frombuffer(b"".join(r[3] for r in rows), np.int32).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r[2]) // 4 for r in rows])
    sizes = np.array([r[1] for r in rows], np.int64)
    norm = 100 - LENGTH_SHARE + (LENGTH_SHARE * sizes * documents) // length
    values = weights[held] * ((UNIT * counts) // (1000 * counts + SATURATION * norm[owner]))
    active, column = np.unique(held, return_inverse=True)
    # Documents with the same greatest coordinate are put side by side.
    most = np.lexsort((-values, owner))
    strongest = np.full(len(rows), len(active))
    firsts = np.r_[True, np.diff(owner[most]) > 0]
    strongest[owner[most[firsts]]] = column[most[firsts]]
    order = np.argsort(strongest, kind="stable")
    place = np.empty(len(rows), np.int64)
    place[order] = np.arange(len(rows))
    matrix = np.zeros((len(rows), len(active)), np.int64)
    matrix[place[owner], column] = values
    missing = np.array([rows[i][0] is None for i in order], np.int64)
    ids = np.array([rows[i][0] or 0 for i in order], np.int64)
    among = np.full(len(weights), -1)
    among[active] = np.arange(len(active))
    pairs = reaching(items, levels(matrix, FAN_OUT), active, best.floors)
    for item_place, members in zip(*_grouped(pairs)):
        item = items.order[item_place]
        columns = among[items.held[item]]
        scores = matrix[np.ix_(members, columns[columns >= 0])].sum(1)
        best.add(item, scores, missing[members], ids[members])


def _grouped(pairs: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    if not len(pairs):
        return [], []
    starts = np.flatnonzero(np.r_[True, np.diff(pairs[:, 0]) != 0])
    return pairs[starts, 0].tolist(), np.split(pairs[:, 1], starts[1:])


def searched(counted: DataFrame, held: list[list[int]], weights: list[int], documents: int, length: int, k: int,
             floors: list[int]) -> DataFrame:
    """FOUND: the ``k`` best documents of each task for each item, none below its floor."""
    batch = max(FAN_OUT, CELLS // max(1, len(weights)))

    def run(batches: Batches) -> Iterator[list[tuple]]:
        weighted = np.array(weights, np.int64)
        items = ItemTree([np.array(h, np.int64) for h in held], weighted)
        best, waiting = Best(len(held), k, np.array(floors, np.int64)), []
        for rows in batches:
            waiting += rows
            while len(waiting) >= batch:
                _search_batch(waiting[:batch], items, weighted, documents, length, best)
                waiting = waiting[batch:]
        if waiting:
            _search_batch(waiting, items, weighted, documents, length, best)
        yield from best.rows()

    return map_rows(counted, run, FOUND)


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """The search for the items of a block, given by their terms."""
    spark = docs.sparkSession
    by_item: dict[int | None, list[bytes]] = {}
    for item, term in pairs.collect():  # bounded by BLOCK_TERMS
        by_item.setdefault(item, []).append(bytes(term))
    numbers = {term: i for i, term in enumerate(sorted({t for held in by_item.values() for t in held}))}
    counted = stored(postings(docs, numbers), "postings")
    sizes = counted.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    names, documents, length = list(by_item), sizes["documents"], sizes["length"]
    schema = "item_id long, rank int, doc_id long, score long"
    if not length:
        return spark.createDataFrame([], schema)
    having = dict(holding(counted).collect())
    weights = [weight(documents, having.get(i, 0)) for i in range(len(numbers))]
    held = [[numbers[t] for t in by_item[name]] for name in names]
    some = F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(SEEDS)) == 0
    seeds = best_of(searched(counted.where(some), held, weights, documents, length, k, [0] * len(held)), k)
    known = {r["item"]: r["score"] for r in seeds.where(F.col("rank") == k).select("item", "score").collect()}
    found = searched(counted, held, weights, documents, length, k, [known.get(i, 0) for i in range(len(held))])
    ids = F.array(*[F.lit(name).cast("long") for name in names])
    return best_of(found, k).select(F.element_at(ids, F.col("item").cast("int") + 1).alias("item_id"), "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id``, ``rank``, ``doc_id`` and ``score``."""
    pairs = stored(item_terms(items), "item-terms")
    blocks = max(1, -(-pairs.count() // BLOCK_TERMS))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = [_search_block(docs, pairs.where(block == number), k) for number in range(blocks)]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result
