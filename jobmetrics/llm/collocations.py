"""Phrases whose words occur together: best-first branch-and-bound growth of phrases, language by language.

A phrase scores by its weakest cut: ``floor(2000000 * a / (l + r))`` of the occurrences ``a`` of the whole and
those of the two parts, ``l`` and ``r``. Phrases grow by one word at a time, from counted prefixes:

* Of a phrase that starts with ``q``, ``a`` and the ``r`` after its first word are at most and at least ``f(q)`` and
  ``a``, so its score is at most ``2000000 f(q) / (f(first word of q) + f(q))``. The same holds for what it ends with and
  that one's last word. The greater of the two is the bound of ``q``.
* The frontier are the phrases whose bound reaches a score ``floor``; at first that of a language's 8000th best pair of
  words. Only they are extended, at either end. A phrase that reaches the floor has all its parts counted, as their bounds
  are no less, and its extensions by one word, which may take its place: a longer phrase that does has one of those in it.
* If fewer phrases than wanted survive at the floor, it goes down for the language, at last to 0. Otherwise
  everything that could come before the last one wanted, ties included, is known, and the rest need not be.

Texts are tokenized once, into chunks of words numbered within the chunk. A chunk asks about each of its
distinct phrases once (``block_keys``), and gets the count and number of those that are frequent in all chunks, so
a very frequent word or phrase costs one row a chunk. Keys of phrases are the numbers of their prefix and last
word, so nothing rests on hashes but single words, of 128 bits.

Defined results: null texts are empty, texts without a language belong to ``und``; rows may repeat and then
count again. Without frequent phrases there are no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from jobmetrics.llm.block_keys import ASKS, Part, answered, answered_order, distinct, part_count, questions
from jobmetrics.llm.common import ARROW_TYPES, map_rows, release, stored, whole_text
from jobmetrics.llm.hashing import joined, word_hashes

UNDETERMINED = "und"
LONGEST = 4
# Rank of the pair of words whose score the frontier has to reach at first, as a multiple of the phrases wanted.
AHEAD = 4
# Words that a task holds in open chunks; beyond, it closes the largest one.
HELD_WORDS = 2_000_000
# Places of a chunk that are looked at together.
PLACES = 1 << 17
# Numbers of words fit in so many bits, numbers of phrases in the others of 63.
WORD_BITS = 28
SCALE = 2_000_000

# All that ends a piece becomes a comma, which thus is no part of any word.
_TABLE = bytes(ord(",") if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))

_CHUNK = "chunk long, lang string, n long, words binary, counts binary, stream binary"
_REPLIES_DDL = "block long, part long, n long, keys binary, bits binary, totals binary, ids binary, first binary"
_REPLIES = pa.schema([(n.split()[0], pa.int64() if n.endswith("long") else pa.binary()) for n in _REPLIES_DDL.split(", ")])
_KNOWN = ["chunk", "lang", "stream", "word_ids", "word_totals", "grams", "gram_ids", "gram_totals"]
_STATE_DDL = ("chunk long, lang string, stream binary, word_ids binary, word_totals binary, grams binary, gram_ids binary, "
              "gram_totals binary, names binary, named binary, named_totals binary")
_STATE = pa.schema([(n.split()[0], pa.int64() if n.endswith("long") else pa.string() if n.endswith("string") else pa.binary())
                    for n in _STATE_DDL.split(", ")])


class _Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) - 1
        return number


class _Open:
    """A chunk that still gets texts."""

    def __init__(self) -> None:
        self.numbers, self.stream, self.n = _Numbers({b",": -1}), [], 0

    def add(self, text: bytes) -> int:
        words = text.translate(_TABLE).replace(b",", b" , ").split()
        found = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
        self.stream += [found, np.array([-1], np.int32)]
        count = int((found >= 0).sum())
        self.n += count
        return count

    def row(self, chunk: int, lang: str) -> tuple:
        stream = np.concatenate(self.stream)
        counts = np.bincount(stream[stream >= 0], minlength=len(self.numbers) - 1).astype(np.uint32)
        words = list(self.numbers)[1:]
        return chunk, lang, self.n, b" ".join(words), counts.tobytes(), stream.tobytes()


def chunked(docs: DataFrame) -> DataFrame:
    """The words of the texts in chunks of one language each, numbered within the chunk."""

    def run(batches: Iterator[list[tuple]]) -> Iterable[list[tuple]]:
        chunk, held, open_chunks = TaskContext.get().partitionId() << 32, 0, {}
        for rows in batches:
            for lang, text in rows:
                if lang not in open_chunks:
                    open_chunks[lang] = _Open()
                held += open_chunks[lang].add(text)
                if held >= HELD_WORDS:
                    largest = max(open_chunks, key=lambda name: open_chunks[name].n)
                    held -= open_chunks[largest].n
                    yield [open_chunks.pop(largest).row(chunk, largest)]
                    chunk += 1
        for lang, found in open_chunks.items():
            if found.n:
                yield [found.row(chunk, lang)]
                chunk += 1

    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNDETERMINED))
    return map_rows(docs.select(lang.alias("lang"), whole_text().cast("binary").alias("text")), run, _CHUNK)


def _words_asked(lang: str, words: bytes) -> np.ndarray:
    """Hash pairs of a chunk's words, apart for each language."""
    hashes, _ = word_hashes([words])
    salt = np.frombuffer(xxhash.xxh3_128_digest(lang.encode("utf-8", "surrogatepass")), np.uint64)
    return np.stack([joined(hashes[:, s], salt[s:s + 1], s) for s in (0, 1)], 1)


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


class Chunk:
    """A chunk whose frequent words, and phrases of some length, are known by number and count.

    ``stream`` has the place of each word among ``word_ids``, -1 between pieces; ``grams`` that of the phrase that starts
    there among ``gram_ids``, -1 if it is rare or was not asked about. Single words are not stored twice.
    """

    def __init__(self, row: dict) -> None:
        self.row = row
        self.stream = np.frombuffer(row["stream"], np.int32)
        self.word_ids, self.word_totals = _longs(row["word_ids"]), _longs(row["word_totals"])
        single = row["grams"] is None
        self.grams = self.stream if single else np.frombuffer(row["grams"], np.int32)
        self.gram_ids = self.word_ids if single else _longs(row["gram_ids"])
        self.gram_totals = self.word_totals if single else _longs(row["gram_totals"])

    def asked(self, size: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct phrases of ``size`` words on the frontier: keys, where they start, which one it is, how often."""
        places, found = [np.zeros(0, np.int32)], [np.zeros(0, np.uint64)]
        for start in range(0, len(self.grams) - 1, PLACES):
            some = self.grams[start:start + PLACES + 1]
            at = start + np.flatnonzero((some[:-1] >= 0) & (some[1:] >= 0))
            left, right, last = self.grams[at], self.grams[at + 1], self.stream[at + size - 1]
            grows = self._bound(left, self.stream[at], self.stream[at + size - 2]) >= least
            grows |= self._bound(right, self.stream[at + 1], last) >= least
            places.append(at[grows].astype(np.int32))
            found.append((self.gram_ids[left[grows]] << WORD_BITS | self.word_ids[last[grows]]).astype(np.uint64))
        found = np.concatenate(found)
        keys, which, counts = distinct(found)
        return keys, np.concatenate(places), which, counts

    def _bound(self, grams: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """What no phrase that starts or ends with these can exceed, with room for the rounding of doubles."""
        total = self.gram_totals[grams].astype(float)
        return SCALE * total / (np.minimum(self.word_totals[first], self.word_totals[last]) + total) * (1 + 1e-9) + 1

    def grown(self, size: int, least: int, parts: int, replies: list[tuple]) -> dict:
        """The state with phrases of ``size`` words, without what is in none of them."""
        keys, at, which, _ = self.asked(size, least)
        totals, ids, _ = _values(keys, parts, replies)
        frequent = totals > 0
        place = np.where(frequent, np.cumsum(frequent) - 1, -1).astype(np.int32)
        grams = np.full(len(self.grams), -1, np.int32)
        grams[at] = place[which]
        inside = np.zeros(len(grams), bool)
        for k in range(size):
            inside[np.flatnonzero(grams >= 0) + k] = True
        left = inside | np.r_[False, inside[:-1]]
        return {**self.row, "stream": np.where(inside, self.stream, -1)[left].astype(np.int32).tobytes(),
                "grams": grams[left].tobytes(), "gram_ids": ids[frequent].tobytes(), "gram_totals": totals[frequent].tobytes()}


def _values(keys: np.ndarray, parts: int, replies: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Total, number and whether this chunk is the first to ask, for each key; totals of rare ones are 0."""
    told = sorted(replies, key=lambda r: r[0])
    totals, ids, first = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    if told:
        frequent = np.concatenate([np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool) for _, n, bits, *_ in told])
        at = answered_order(keys, parts)[frequent]
        totals[at] = np.concatenate([_longs(r[3]) for r in told])
        ids[at] = np.concatenate([_longs(r[4]) for r in told])
        first[at] = np.concatenate([np.unpackbits(np.frombuffer(r[5], np.uint8), count=len(r[3]) // 8).astype(bool) for r in told])
    return totals, ids, first


def counted(asks: DataFrame, width: int, least: int, parts: int, word_level: bool) -> DataFrame:
    """Answers for each chunk, and one row a part with the frequent keys themselves (``block`` is null)."""
    room = 1 << (WORD_BITS if word_level else 63 - WORD_BITS)

    def answer(number: int, part: Part) -> list[tuple]:
        frequent = part.totals >= least
        ids = np.where(frequent, (np.cumsum(frequent) - 1) * parts + number, 0)
        if len(ids) and ids.max() >= room:
            raise OverflowError(f"numbers of frequent words or phrases go beyond {room}")
        seen = np.full(len(part.keys), len(part.which))
        np.minimum.at(seen, part.which, np.arange(len(part.which)))
        first = seen[part.which] == np.arange(len(part.which))
        rows = [(None, number, int(frequent.sum()), np.ascontiguousarray(part.keys[frequent]).tobytes(), None,
                 part.totals[frequent].tobytes(), ids[frequent].tobytes(), None)]
        for (block, which), (_, owner) in zip(part.by_block(part.which), part.by_block(first)):
            known = frequent[which]
            rows.append((block, number, len(which), None, np.packbits(known).tobytes(), part.totals[which[known]].tobytes(),
                         ids[which[known]].tobytes(), np.packbits(owner[known]).tobytes()))
        return rows

    return answered(asks, width, answer, _REPLIES, _REPLIES_DDL)


def _first_state(row: dict, parts: int, replies: list[tuple]) -> dict:
    """A chunk of words that are numbered and counted over all chunks; runs of two frequent words or more are left."""
    keys, which, _ = distinct(_words_asked(row["lang"], row["words"]))
    totals, ids, first = (v[which] for v in _values(keys, parts, replies))
    frequent = totals > 0
    place = np.r_[np.where(frequent, np.cumsum(frequent) - 1, -1), -1].astype(np.int32)
    stream = place[np.frombuffer(row["stream"], np.int32)]
    here = stream >= 0
    paired = here & (np.r_[False, here[:-1]] | np.r_[here[1:], False])
    stream = np.where(paired, stream, -1)
    stream = stream[paired | np.r_[True, paired[:-1]]].astype(np.int32)
    owned = frequent & first
    words = row["words"].split()
    return {"chunk": row["chunk"], "lang": row["lang"], "stream": stream.tobytes(), "word_ids": ids[frequent].tobytes(),
            "word_totals": totals[frequent].tobytes(), "grams": None, "gram_ids": None, "gram_totals": None,
            "names": b" ".join([words[i] for i in np.flatnonzero(owned).tolist()]),
            "named": ids[owned].tobytes(), "named_totals": totals[owned].tobytes()}


def each_row(df: DataFrame, function: Callable[..., list[tuple]], ddl: str) -> DataFrame:
    """``map_rows`` for large rows: one is turned into Python at a time."""
    schema = pa.schema([(f.split()[0], ARROW_TYPES[f.split()[1]]) for f in ddl.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                rows = function(*[column[at].as_py() for column in batch.columns])
                if rows:
                    made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    del rows
                    yield made
                    del made
                release()

    return df.mapInArrow(run, ddl)


def _next_state(chunks: DataFrame, replies: DataFrame, step: Callable[[dict, list[tuple]], dict]) -> DataFrame:
    """``step(row, replies)`` for each chunk with what was answered to it."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        told = list(zip(*[right.column(c).to_pylist() for c in ("part", "n", "bits", "totals", "ids", "first")]))
        found = pa.Table.from_pylist([step(row, told) for row in left.to_pylist()], schema=_STATE)
        del told
        release()
        return found

    told = replies.where(F.col("block").isNotNull()).withColumnRenamed("block", "chunk")
    return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, _STATE_DDL)


def _phrases_asked(chunks: DataFrame, size: int, floors: dict[str, int], parts: int) -> DataFrame:
    def run(*values) -> list[tuple]:
        row = dict(zip(_KNOWN, values))
        keys, counts = Chunk(row).asked(size, floors.get(row["lang"], 0))[::3]
        return questions(row["chunk"], keys, counts, parts)

    return each_row(chunks.select(*_KNOWN), run, ASKS)


def _entries(replies: DataFrame) -> DataFrame:
    """Prefix, last word, number and count of each frequent phrase."""

    def run(keys: bytes, totals: bytes, ids: bytes) -> list[tuple]:
        key = _longs(keys)
        return list(zip((key >> WORD_BITS).tolist(), (key & (1 << WORD_BITS) - 1).tolist(), _longs(ids).tolist(), _longs(totals).tolist()))

    return each_row(replies.where(F.col("block").isNull()).select("keys", "totals", "ids"), run,
                    "prefix long, last long, id long, a long")


def _names(chunks: DataFrame) -> DataFrame:
    """The frequent words of each language: number, count and text."""

    def run(lang: str, names: bytes, ids: bytes, totals: bytes) -> list[tuple]:
        return [(lang, i, t, w) for i, t, w in zip(_longs(ids).tolist(), _longs(totals).tolist(), names.split())]

    words = each_row(chunks.select("lang", "names", "named", "named_totals"), run, "lang string, id long, a long, text binary")
    return words.withColumn("text", F.col("text").cast("string"))


def _scored(phrases: DataFrame) -> DataFrame:
    """``part_l``, ``part_r`` and ``score`` of the lowest-scoring cut; of equal ones the first."""
    def cut(k: Column) -> Column:
        left, right = F.element_at("l", k), F.element_at("r", k)
        scaled = F.col("a").cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(7,0)")
        value = F.call_function("div", scaled, left.cast("decimal(20,0)") + right.cast("decimal(20,0)"))
        return F.struct(value.cast("long").alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    lowest = F.array_min(F.transform(F.sequence(F.lit(1), F.size("l")), cut))
    return phrases.withColumn("cut", lowest).select(
        *phrases.columns, F.col("cut.l").alias("part_l"), F.col("cut.r").alias("part_r"), F.col("cut.score").alias("score"))


def _pairs(entries: DataFrame, names: DataFrame) -> DataFrame:
    """Phrases of two words. ``tail`` numbers the phrase without the first word, ``l`` and ``r`` count the parts of each cut."""
    first = names.select("lang", F.col("id").alias("prefix"), F.col("a").alias("first_a"), F.col("text").alias("first_text"))
    last = names.select(F.col("id").alias("last"), F.col("a").alias("last_a"), F.col("text").alias("last_text"))
    return entries.join(first, "prefix").join(last, "last").select(
        "lang", "id", "prefix", "last", F.col("last").alias("tail"), "a", F.concat_ws(" ", "first_text", "last_text").alias("text"),
        "last_text", F.array("first_a").alias("l"), F.array("last_a").alias("r"))


def _longer(entries: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases of one word more, from what they begin and end with."""
    head = shorter.select("lang", F.col("id").alias("prefix"), F.col("tail").alias("inner"), F.col("a").alias("head_a"),
                          F.col("text").alias("head_text"), F.col("l").alias("head_l"))
    tail = shorter.select(F.col("id").alias("tail"), F.col("prefix").alias("inner"), "last", F.col("a").alias("tail_a"), "last_text",
                          F.col("r").alias("tail_r"))
    return entries.join(head, "prefix").join(tail, ["inner", "last"]).select(
        "lang", "id", "prefix", "last", "tail", "a", F.concat_ws(" ", "head_text", "last_text").alias("text"), "last_text",
        F.concat("head_l", F.array("head_a")).alias("l"), F.concat(F.array("tail_a"), "tail_r").alias("r"))


def _surviving(phrases: DataFrame, longer: DataFrame | None) -> DataFrame:
    """Without those that occur within one longer phrase in 80 of 100 cases or more."""
    if longer is None:
        return phrases
    holding = longer.select(F.col("prefix").alias("id"), F.col("a").alias("longer_a")).unionByName(
        longer.select(F.col("tail").alias("id"), F.col("a").alias("longer_a")))
    most = holding.groupBy("id").agg(F.max("longer_a").alias("longer_a"))
    wide = [F.coalesce(F.col(c), F.lit(0)).cast("decimal(20,0)") for c in ("longer_a", "a")]
    return phrases.join(most, "id", "left").where(100 * wide[0] < 80 * wide[1]).drop("longer_a")


def _score_at(pairs: DataFrame, rank: int) -> dict[str, int]:
    """Score of the ``rank``-th best pair of words of each language, 0 if there are fewer: a number a language."""
    scores = pairs.groupBy("lang", "score").agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("score")))
    reached = scores.withColumn("above", above).groupBy("lang").agg(F.max(F.when(F.col("above") >= rank, F.col("score"))).alias("floor"))
    return {r["lang"]: r["floor"] or 0 for r in reached.collect()}


def collocations(docs: DataFrame, least: int = 30, limit: int = 2000) -> DataFrame:
    """The ``limit`` best phrases of each language of those that occur ``least`` times: ``lang``, ``rank``, ``phrase``, ``a``,
    ``l``, ``r``, ``n`` (words of the language) and ``score``."""
    spark = docs.sparkSession
    chunks = stored(chunked(docs), "chunks")
    sizes = chunks.groupBy("lang").agg(F.sum("n").alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    parts = part_count(spark, total)

    def asked_words(number: int, lang: str, words: bytes, counts: bytes) -> list[tuple]:
        keys, which, _ = distinct(_words_asked(lang, words))
        there = np.zeros(len(keys), np.uint32)
        np.add.at(there, which, np.frombuffer(counts, np.uint32))
        return questions(number, keys, there, parts)

    asks = each_row(chunks.select("chunk", "lang", "words", "counts"), asked_words, ASKS)
    told = stored(counted(asks, 2, least, parts, word_level=True), "words")
    first = stored(_next_state(chunks.select("chunk", "lang", "words", "stream"), told, lambda row, replies: _first_state(row, parts, replies)), "words-in-chunks")
    told = stored(counted(_phrases_asked(first, 2, {}, parts), 1, least, parts, word_level=False), "pairs")
    pairs = stored(_scored(_pairs(_entries(told), _names(first))), "scored-pairs")
    second = stored(_next_state(first.select(*_KNOWN), told, lambda row, replies: Chunk(row).grown(2, 0, parts, replies)), "pairs-in-chunks")

    rank = AHEAD * limit
    floors = _score_at(pairs, rank)
    while True:
        now = dict(floors)
        told3 = stored(counted(_phrases_asked(second, 3, now, parts), 1, least, parts, word_level=False), "threes")
        threes = stored(_scored(_longer(_entries(told3), pairs)), "scored-threes")
        # Stored, so that no task has two Python workers at once.
        third = stored(_next_state(second.select(*_KNOWN), told3, lambda row, replies: Chunk(row).grown(3, now.get(row["lang"], 0), parts, replies)),
                       "threes-in-chunks")
        told4 = stored(counted(_phrases_asked(third, LONGEST, now, parts), 1, least, parts, word_level=False), "fours")
        fours = _scored(_longer(_entries(told4), threes))
        reaching = F.lit(0)
        for lang, floor in now.items():
            reaching = F.when(F.col("lang") == lang, floor).otherwise(reaching)
        survivors = [_surviving(p, q) for p, q in ((pairs, threes), (threes, fours), (fours, None))]
        settled = stored(survivors[0].unionByName(survivors[1]).unionByName(survivors[2]).where(F.col("score") >= reaching), "settled")
        found = {r["lang"]: r["count"] for r in settled.groupBy("lang").count().collect()}
        short = [lang for lang, floor in now.items() if floor and found.get(lang, 0) < limit]
        if not short:
            break
        rank *= 4
        lower = _score_at(pairs, rank)
        # A floor that many pairs share may stay where it is; then all is expanded.
        floors |= {lang: lower[lang] if lower[lang] < now[lang] else 0 for lang in short}
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "text")
    ranked = settled.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), F.col("text").alias("phrase"), "a", F.col("part_l").alias("l"),
        F.col("part_r").alias("r"), "n", "score")
