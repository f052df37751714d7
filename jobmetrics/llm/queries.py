"""The queries of this folder, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmetrics.llm import (
    chunked_bpe, collocations, dual_tree_search, embeddings, fingerprints, html_density, language, minhash, packing, quality, repeated_windows, token_files,
    toxicity,
)
from jobmetrics.llm.common import held_out, prepared
from jobmetrics.llm.oracles import oracle_sql as oracle_sql
from jobmetrics.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_and_edit(table(spark, sf_dir, "documents"))


@_query
def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, kept_back = table(spark, sf_dir, "documents"), held_out("doc_id", 4, 2)
    languages = language.learn(docs, ~kept_back)
    return language.with_language(docs.select("doc_id", "text"), languages).select(
        "doc_id", kept_back.alias("held_out"), F.col("mixture.lang").alias("lang_pred"), "mixture.score",
        "mixture.proportion", "mixture.languages")


@_query
def op3_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.main_text(table(spark, sf_dir, "pages"))


@_query
def op4_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, kept_back = table(spark, sf_dir, "documents"), held_out("doc_id", 4, 2)
    ranking = quality.learn(docs, table(spark, sf_dir, "labels"), ~kept_back)
    return quality.with_score(docs.select("doc_id", "text"), ranking).select(
        "doc_id", kept_back.alias("held_out"), "score", quality.is_good().cast("int").alias("predicted"))


@_query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY, PATTERN, end_id=0)


@_query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


@_query
def op7_itq_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


@_query
def op8_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked_bpe.encode_and_decode(table(spark, sf_dir, "documents"), RANKS, PATTERN)


@_query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, VOCABULARY, PATTERN, end_id=2)
    return token_files.read_token_files(spark, path)


@_query
def op10_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, kept_back = table(spark, sf_dir, "documents"), held_out("doc_id", 3, 1)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~kept_back)
    return toxicity.with_toxicity(docs.select("doc_id", "text"), model).select(
        "doc_id", kept_back.alias("held_out"), "toxicity.score",
        (F.col("toxicity.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "toxicity.spans")



@_query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, limit=2000)


@_query
def op12_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@_query
def op13_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeated_windows.without_repeats(table(spark, sf_dir, "documents"), length=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
