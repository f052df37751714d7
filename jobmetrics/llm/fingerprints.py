"""Document fingerprints: every shingle hash in a fixed fraction of the hash range.

A sketch keeps the hashes of those five-word shingles whose 64-bit hash lies in the lowest
1/SCALE of the range. Membership depends on the hash alone, so sketches merge by union, grow
with their documents, and compare documents of very unequal lengths: the share of the smaller
sketch that the larger one has too is how much of the shorter document the longer one contains.
SCALE is 1, all hashes, so that this holds for short texts too; with a larger scale it is an
estimate, which for texts of a few shingles is poor, and a text of which no hash lies below
keeps its lowest hash instead. Only texts without words have an empty sketch. Everything is
Spark SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobmetrics.llm.common import LOWEST, id_bounds, long_array, range_of, shuffle_width, whole_text

SHINGLE_WORDS = 5
SCALE = 1
RANGES_PER_PARTITION = 4


def words(text: Column) -> Column:
    """Lower-cased runs of characters other than white space."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def shingle_hashes(word_array: Column, width: int = SHINGLE_WORDS) -> Column:
    """A hash for each run of ``width`` words; fewer words are one run, no words none.

    ``word_array`` should be a column, as each run refers to it ``width`` times.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size(word_array) - width, F.lit(0)))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(word_array, i + k) for k in range(width)]))
    return F.when(F.size(word_array) > 0, hashes).otherwise(F.array().cast("array<bigint>"))


def below(hashes: Column, scale: int = SCALE) -> Column:
    """The distinct hashes in the lowest 1/scale of the range, in ascending order."""
    highest = F.lit(LOWEST + (1 << 64) // scale - 1)
    kept = F.filter(hashes, lambda h: h <= highest) if scale > 1 else hashes
    return F.sort_array(F.array_distinct(kept))


def or_lowest(kept: Column, hashes: Column) -> Column:
    """A sketch from what lies below the threshold, or else the lowest hash."""
    return F.when((F.size(kept) == 0) & (F.size(hashes) > 0), F.array(F.array_min(hashes))).otherwise(kept)


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of two texts together, shingles across their border aside."""
    both = F.array_union(a, b)
    return or_lowest(below(both, scale), both)


def as_string(sketched: Column) -> Column:
    return F.concat_ws(" ", F.transform(sketched, lambda h: F.hex(h)))


def containment(a: Column, b: Column) -> Column:
    """Share of the smaller sketch that is in the other; 1 for two empty ones, 0 for one empty one."""
    smaller = F.least(F.size(a), F.size(b))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when(smaller == 0, 0.0)
            .otherwise(F.size(F.array_intersect(a, b)) / smaller))


def resemblance(a: Column, b: Column) -> Column:
    """Common hashes over all hashes of both; 1 for two empty sketches."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the sketch of a column in which no text is null."""
    held = [f"_{out}_{part}" for part in ("words", "hashes", "below")]
    return (df.withColumn(held[0], words(F.col(text)))
            .withColumn(held[1], shingle_hashes(F.col(held[0])))
            .withColumn(held[2], below(F.col(held[1])))
            .withColumn(out, or_lowest(F.col(held[2]), F.col(held[1])))
            .drop(*held))


def with_next(df: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of the row with the next doc_id, the first after the last, as ``next_<column>``.

    Rows are dealt out by ranges of doc_id with equally many rows. The first rows of each range
    also go to the range before it, as only they follow its last row. Rows with the same doc_id
    follow each other in the order of their text's hash; a null doc_id comes first.
    """
    bounds = id_bounds(df, "doc_id", RANGES_PER_PARTITION * shuffle_width(df.sparkSession))
    number = range_of("doc_id", bounds)
    is_first = F.array_contains(long_array(bounds or [LOWEST]), F.coalesce("doc_id", F.lit(LOWEST)))
    before = F.when(F.col("_range") == 0, max(len(bounds) - 1, 0)).otherwise(F.col("_range") - 1)
    own = F.struct(F.col("_range").alias("range"), F.lit(False).alias("copy"))
    places = F.when(is_first, F.array(own, F.struct(before.alias("range"), F.lit(True).alias("copy")))
                    ).otherwise(F.array(own))
    dealt = (df.withColumn("_range", number).withColumn("_place", F.explode(places))
             .select(*df.columns, "_place.range", "_place.copy"))
    order = Window.partitionBy("range").orderBy("copy", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    following = [F.lead(c).over(order).alias(f"next_{c}") for c in columns]
    return dealt.select("*", *following).where(~F.col("copy")).drop("range", "copy")


def fingerprint_and_edit(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness.

    Edited: the last floor(n_chars / 4) code points are replaced by as many first ones of the
    next document. ``near_edited`` and ``near_next`` are containment; ``jaccard_edited`` and
    ``jaccard_next`` resemblance. Null text counts as empty, an empty table gives no rows, and
    columns other than doc_id and text are left out.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    replaced = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - replaced),
                      F.substring("next_text", F.lit(1), replaced))
    # Sketches are made after the rows have been dealt out, which so moves texts only.
    found = with_next(base.withColumn("n_chars", F.char_length("text").cast("long")), ["text"]).withColumn("edited", edited)
    for text, sketch in (("text", "sketch"), ("next_text", "next_sketch"), ("edited", "edited_sketch")):
        found = with_sketch(found, text, sketch)
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_string(F.col("sketch")).alias("fingerprint"), as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("jaccard_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("jaccard_next"))
