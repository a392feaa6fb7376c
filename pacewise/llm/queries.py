"""Registered queries of the training-data operators, over whole tables, with their contracts' columns."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pacewise.llm import decontamination, language, licenses, packing, personal_data, prefix_trie, quality, quotations, shingle_join, spelling, token_counts, urls, vector_join
from pacewise.llm.common import small_batches, table

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


@_query
def op1_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    return shingle_join.classes(table(spark, folder, "documents"), width=5, percent=75)


@_query
def jaccard_link_counts(spark: SparkSession, folder: str) -> DataFrame:
    """op1 with the number of links of each document, which the columns of op1's SQL do not have."""
    small_batches(spark)
    return shingle_join.link_counts(table(spark, folder, "documents"), width=5, percent=75)


@_query
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licenses(table(spark, folder, "documents")).drop("detections")


@_query
def op3_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    return quotations.linked(table(spark, folder, "conversations"))


@_query
def op4_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_join.near_vectors(table(spark, folder, "embeddings"), cosine=0.9)


@_query
def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return personal_data.personal_data(docs, personal_data.fit(docs))


@_query
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identified(table(spark, folder, "documents"), folds=4, fold=2)


@_query
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@_query
def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"), folds=3, fold=1)


@_query
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.hit_counts(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@_query
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, folder, "documents")
    return packing.piece_digests(packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), length=4096, end_id=2))


@_query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_nodes(table(spark, folder, "conversations"))


@_query
def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    rules = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
    return urls.judged(pages, urls.fit(pages), rules)


@_query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))
