"""The corpus pipeline: documents through quality, language, near-duplicates and packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from jobmetrics.llm import language, minhash, packing, quality
from jobmetrics.llm.common import held_out, prepared, stored, whole_text
from jobmetrics.llm.queries import PATTERN, VOCABULARY

# A document is in a language if that has at least this share; a passage in another one is no fault.
LEAST_PROPORTION = 1 / 3
# Python workers live on from stage to stage beside what the stages need in the JVM, so they get less at a time.
ROWS_AT_A_TIME, WORDS_KEPT = 200, 100_000


def session(spark: SparkSession) -> SparkSession:
    """The operators' session settings, with smaller Arrow batches."""
    prepared(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_A_TIME))
    return spark


def spare_name(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold of the ranking learned from ``labels``."""
    labels = session(spark).read.parquet(f"{sf_dir}/labels.parquet")
    ranking = quality.learn(docs, labels, ~held_out("doc_id", 4, 2))
    score = spare_name(docs, "score")
    return quality.with_score(docs, ranking, score).where(quality.is_good(score)).select(*docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, in the languages learned, of which one has a fair share."""
    session(spark)
    languages = language.learn(docs, ~held_out("doc_id", 4, 2))
    found = spare_name(docs, "mixture")
    known = ((F.col(f"{found}.lang") != language.UNDETERMINED) & (F.col(f"{found}.proportion") >= LEAST_PROPORTION)
             & language.in_known_language(languages, whole_text()))
    return language.with_language(docs, languages, found).where(known).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates, and of rows with one id one.

    Rows without an id belong to no group and stay.
    """
    session(spark)
    kept = (minhash.near_duplicates(docs, width=5).where(F.col("kept") & F.col("doc_id").isNotNull())
            .select("doc_id").distinct())
    number = spare_name(docs, "number")
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    first = (docs.join(kept, "doc_id", "left_semi").withColumn(number, F.row_number().over(order))
             .where(F.col(number) == 1).select(*docs.columns))
    return first.union(docs.where(F.col("doc_id").isNull()))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the earlier stages kept, in windows of 1024 ids."""
    session(spark)
    return packing.pack(docs, VOCABULARY, PATTERN, end_id=0, words_kept=WORDS_KEPT)


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near-duplicates", without_near_duplicates),
    ("packing", pack),
]

# Stages learn models and tokenize, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again before the next."""
    docs = session(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
