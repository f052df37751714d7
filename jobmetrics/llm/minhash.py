"""Near-duplicates by MinHash signatures with banding, checked on whole shingle sets.

1. Every text gives its set of word shingles as 64-bit hashes, and of that a signature: the
   minima of many universal hash functions. Texts with equal sets form one class; from there on
   a class has one row, however many copies there are.
2. Rows of the signature are grouped into bands; classes that agree in a whole band meet in a
   bucket. A bucket does not give pairs of all its members. First each member is paired with two
   hubs of each of its buckets, and the hubs it meets most often are checked.
3. Connected components of the links so found leave few buckets with members of different
   components. Only there members are compared with each other, within the task that holds the
   bucket (or two blocks of a large one): by signatures first, where a pair counts in the first
   bucket it shares, and those that have a partner again on whole sets. A task gives no pairs
   but one link for each two components it finds connected.
4. A check looks at the signatures first and then computes the similarity of the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from jobmetrics.llm.common import Batches, map_rows, stored, whole_text
from jobmetrics.llm.components import components
from jobmetrics.llm.hashing import mixed, word_hashes

# At similarity 0.8, two signatures share no band with probability (1 - 0.8^5)^36 < 1e-6.
BANDS, ROWS = 36, 5
HASHES = BANDS * ROWS
PERCENT = 80
# Signatures that agree in less than this share are not checked further: at similarity 0.8 the
# share has a standard deviation of 0.03.
LEAST_AGREEMENT = 0.8 - 5 * (0.8 * 0.2 / HASHES) ** 0.5
# Hubs that a member is checked against, and members that one task compares with as many others.
HUBS, MEMBERS = 3, 2048
BLOCK = 1024

_draw = np.random.default_rng(20_000)
_MULTIPLY = _draw.integers(0, 1 << 64, HASHES, np.uint64) | np.uint64(1)
_ADD = _draw.integers(0, 1 << 64, HASHES, np.uint64)
_BAND_MULTIPLY = _draw.integers(0, 1 << 64, (BANDS, ROWS), np.uint64) | np.uint64(1)
_WORD_MULTIPLY = _draw.integers(0, 1 << 64, 64, np.uint64) | np.uint64(1)

SKETCH_SCHEMA = "doc_id long, n_shingles long, key_a long, key_b long, signature binary, buckets array<long>"


def shingles(text: str, width: int) -> np.ndarray:
    """The set of hashes of a text's shingles of ``width`` words, in ascending order.

    Words are runs of characters other than space and 09 to 0D, with A-Z in lower case. Fewer
    words than ``width`` are one shingle.
    """
    hashes = word_hashes([text.encode("utf-8", "surrogatepass").lower()])[0][:, 0]
    if not len(hashes):
        return np.zeros(0, np.uint64)
    used = min(width, len(hashes))
    total = np.full(len(hashes) - used + 1, np.uint64(used))
    for k in range(used):
        total = mixed(total + hashes[k:len(hashes) - used + 1 + k] * _WORD_MULTIPLY[k])
    return np.unique(total)


def signature(found: np.ndarray) -> np.ndarray:
    """Minima of multiply-add-shift hashes of a non-empty set."""
    short = found >> np.uint64(32)
    least = np.full(HASHES, np.iinfo(np.uint64).max)
    for at in range(0, len(short), BLOCK):
        np.minimum(least, (_MULTIPLY[:, None] * short[at:at + BLOCK] + _ADD[:, None]).min(1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def bucket_keys(signed: np.ndarray) -> np.ndarray:
    """One key for each band; bands have keys of their own."""
    rows = signed.reshape(BANDS, ROWS).astype(np.uint64) * _BAND_MULTIPLY
    return mixed(rows.sum(1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _WORD_MULTIPLY[0])


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """SKETCH_SCHEMA for each row; signature and buckets are null for an empty set."""

    def run(batches: Batches) -> Iterable[list[tuple]]:
        for rows in batches:
            out = []
            for doc, text in rows:
                found = shingles(text, width)
                key = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), "<i8").tolist()
                # Buckets hold what is equal in the signature as it is kept, so that both tell the same of a pair.
                signed = signature(found).astype("<u2") if len(found) else None
                out.append((doc, len(found), *key, None if signed is None else signed.tobytes(),
                            None if signed is None else bucket_keys(signed).view(np.int64).tolist()))
            yield out

    return map_rows(docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")), run, SKETCH_SCHEMA)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, on whole sets."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def linked(pairs: DataFrame, signatures: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (u, v) that are similar: by signatures first, then on whole sets."""

    def side(table: DataFrame, node: str, *columns: str) -> DataFrame:
        return table.select(F.col("doc_id").alias(node), *[F.col(c).alias(f"{node}_{c}") for c in columns])

    def agree(batches: Batches) -> Iterable[list[tuple]]:
        for rows in batches:
            u, v = (np.frombuffer(b"".join(r[k] for r in rows), "<u2").reshape(-1, HASHES) for k in (2, 3))
            near = (u == v).mean(1) >= LEAST_AGREEMENT
            yield [(r[0], r[1]) for r, keep in zip(rows, near) if keep]

    def compare(batches: Batches) -> Iterable[list[tuple]]:
        for rows in batches:
            yield [(u, v) for u, v, a, b in rows if similar(shingles(a, width), shingles(b, width), percent)]

    signed = (pairs.join(side(signatures, "u", "signature"), "u").join(side(signatures, "v", "signature"), "v")
              .select("u", "v", "u_signature", "v_signature"))
    near = stored(map_rows(signed, agree, "u long, v long"), "near-pairs")
    whole = (near.join(side(texts, "u", "text"), "u").join(side(texts, "v", "text"), "v")
             .select("u", "v", "u_text", "v_text"))
    return stored(map_rows(whole, compare, "u long, v long"), "links")


def with_partner(members: list[tuple], across: bool) -> np.ndarray:
    """Which members have one of another component whose size and signature allow a link.

    Members are (block, band, component, n_shingles, signature); ``across`` compares those of
    different blocks only. A pair that shares an earlier bucket is left to that.
    """
    block, component, n = (np.array([m[k] for m in members]) for k in (0, 2, 3))
    signed = np.frombuffer(b"".join(m[4] for m in members), "<u2").reshape(-1, HASHES)
    band, found = members[0][1], np.zeros(len(members), bool)
    for i in range(len(members) - 1):
        fits = (component[i + 1:] != component[i]) & (
            100 * np.minimum(n[i + 1:], n[i]) >= PERCENT * np.maximum(n[i + 1:], n[i]))
        others = np.flatnonzero(fits & (block[i + 1:] != block[i]) if across else fits) + i + 1
        if len(others):
            same = signed[others] == signed[i]
            others, same = (x[same.mean(1) >= LEAST_AGREEMENT] for x in (others, same))
            earlier = same[:, :band * ROWS].reshape(len(others), band, ROWS).all(2).any(1)
            others = others[~earlier]
        if len(others):
            found[i] = True
            found[others] = True
    return found


def connecting_links(members: list[tuple], across: bool, width: int, percent: int) -> list[tuple[int, int]]:
    """Links that connect components, as many as that takes: whole sets of (block, component, doc_id, text)."""
    block, component, doc = (np.array([m[k] for m in members]) for k in (0, 1, 2))
    sets = [shingles(m[3], width) for m in members]
    sizes = np.array([len(s) for s in sets])
    elements, number = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    names, counts = np.unique(component, return_counts=True)
    largest = names[counts.argmax()]
    links = []
    for i in np.flatnonzero(component != largest):
        mine = np.zeros(len(elements), bool)
        mine[number[starts[i]:starts[i] + sizes[i]]] = True
        common = np.add.reduceat(mine[number].astype(np.int64), starts)
        near = (100 * common >= percent * (sizes + sizes[i] - common)) & (component != component[i])
        if across:
            near &= block != block[i]
        for j in np.flatnonzero(near):
            if component[j] != component[i]:
                links.append((int(min(doc[i], doc[j])), int(max(doc[i], doc[j]))))
                component[component == component[j]] = component[i]
    return links


def groups(batches: Batches) -> Iterable[tuple[tuple, list[tuple]]]:
    """Rows of one (bucket, low, high) after the other, without these columns."""
    rows = (row for batch in batches for row in batch)
    for key, group in groupby(rows, lambda r: r[:3]):
        yield key, [r[3:] for r in group]


def possible_members(batches: Batches) -> Iterable[list[tuple]]:
    for (bucket, low, high), rows in groups(batches):
        found = with_partner([(block, band, component, n, signed)
                              for block, band, component, _, n, signed in rows], low != high)
        yield [(bucket, low, high, r[0], r[2], r[3]) for r, keep in zip(rows, found) if keep]


def bucket_links(batches: Batches, width: int, percent: int) -> Iterable[list[tuple]]:
    for (_, low, high), rows in groups(batches):
        if len(rows) > 1:
            yield connecting_links(rows, low != high, width, percent)


def dealt_by_component(rows: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """Deals the members of buckets to tasks so that every two of different components meet in one of them.

    A bucket of more than ``block`` members is cut into blocks, those of its largest component apart from the others.
    Blocks of others meet each other, and those of the largest component only the others: its members need not
    be compared among themselves. ``low`` and ``high`` name a task's two blocks, ``block`` is the row's own; blocks of the
    largest component have negative numbers. ``sizes`` has the ``count`` of each bucket.
    """
    large = sizes.where(F.col("count") > block).select("bucket")
    parts = rows.select("bucket", "component").join(large, "bucket").groupBy("bucket", "component").agg(F.count("*").alias("n"))
    split = parts.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("n")).select(
        "bucket", F.col("most.component").alias("main"), F.ceil(F.col("most.n") / block).cast("int").alias("main_blocks"),
        F.ceil((F.col("n") - F.col("most.n")) / block).cast("int").alias("other_blocks"))
    hashed, is_main = F.xxhash64("doc_id"), F.col("component") == F.col("main")
    others = F.sequence(F.lit(0), F.col("other_blocks") - 1)
    mains = F.transform(F.sequence(F.lit(1), F.col("main_blocks")), lambda x: -x)
    own = F.when(is_main, -F.pmod(hashed, F.col("main_blocks")) - 1).otherwise(F.pmod(hashed, F.col("other_blocks")))
    met = F.when(F.col("main").isNull(), F.array(F.lit(0))).when(is_main, others).otherwise(F.concat(others, mains))
    group = ["bucket", "low", "high"]
    return (rows.join(split, "bucket", "left").withColumn("block", F.coalesce(own, F.lit(0)).cast("int"))
            .withColumn("other", F.explode(met)).withColumn("low", F.least("block", "other"))
            .withColumn("high", F.greatest("block", "other")).drop("main", "main_blocks", "other_blocks", "other")
            .repartition(*group).sortWithinPartitions(*group, "doc_id"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Texts are linked if 100 times the common shingles are at least ``percent`` times all their
    shingles. ``component_id`` is the least doc_id that can be reached by links. Null and empty
    texts, and texts without words, are linked with nothing. Rows with one doc_id count as one
    document with all their links. A row without doc_id takes no part: its component is null, and
    it is kept. Columns other than doc_id and text are left out.
    """
    if percent < PERCENT:
        raise ValueError(f"the bands are laid out for similarities of at least {PERCENT} percent")
    every = stored(sketches(docs, width), "sketches")
    linkable = every.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    members = linkable.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("node"))
    classes = (linkable.join(members.withColumnRenamed("node", "doc_id"), ["key_a", "key_b", "doc_id"])
               .dropDuplicates(["key_a", "key_b"]))

    placed = classes.select("doc_id", F.posexplode("buckets").alias("band", "bucket"))
    # A hub is the member whose id is least, or greatest, after an exclusive or with the bucket's key.
    coded = F.col("doc_id").bitwiseXOR(F.col("bucket"))
    shared = (placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min(coded).alias("low"), F.max(coded).alias("high"))
              .where("n > 1"))
    meeting = stored(placed.join(shared, "bucket").select("bucket", "band", "doc_id", "low", "high"), "buckets")
    hubs = F.explode(F.array("low", "high")).alias("hub")
    met = (meeting.select("bucket", "doc_id", hubs)
           .select("doc_id", F.col("hub").bitwiseXOR(F.col("bucket")).alias("hub")).where("doc_id <> hub")
           .groupBy("doc_id", "hub").count())
    often = Window.partitionBy("doc_id").orderBy(F.desc("count"), "hub")
    best = met.withColumn("rank", F.row_number().over(often)).where(F.col("rank") <= HUBS)
    pairs = best.select(F.least("doc_id", "hub").alias("u"), F.greatest("doc_id", "hub").alias("v")).distinct()

    involved = meeting.select("doc_id").distinct()
    signatures = stored(classes.join(involved, "doc_id").select("doc_id", "n_shingles", "signature"), "signatures")
    own_text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    texts = stored(own_text.join(involved, "doc_id"), "texts")
    links = linked(pairs, signatures, texts, width, percent)
    first = stored(components(links), "components")

    known = meeting.join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "bucket", "band", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    open_buckets = (known.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"),
                                                F.count("*").alias("count"))
                    .where("a <> b").select("bucket", "count"))
    unsettled = known.join(open_buckets.select("bucket"), "bucket").join(signatures, "doc_id")
    names = ["bucket", "low", "high", "block", "band", "component", "doc_id"]
    possible = stored(map_rows(
        dealt_by_component(unsettled, open_buckets, MEMBERS).select(*names, "n_shingles", "signature"),
        lambda batches: possible_members(batches),
        "bucket long, low int, high int, block int, component long, doc_id long"), "possible")
    group = ["bucket", "low", "high"]
    whole = (possible.join(texts, "doc_id").select(*group, "block", "component", "doc_id", "text")
             .repartition(*group).sortWithinPartitions(*group, "component", "doc_id"))
    also = stored(map_rows(whole, lambda batches: bucket_links(batches, width, percent), "u long, v long").distinct(),
                  "more-links")
    stars = first.select(F.col("node").alias("u"), F.col("component").alias("v")).where("u <> v")
    reached = components(stars.union(also))

    named = members.join(reached, "node", "left").select(
        "key_a", "key_b", F.coalesce("component", "node").alias("component"))
    found = every.select("doc_id", "n_shingles", "key_a", "key_b").join(named, ["key_a", "key_b"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return (found.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), component))
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))
