"""The numbered queries, each over the whole of the table meant for it."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedloom.llm.ann import nearest_neighbours
from feedloom.llm.clustering import clusters
from feedloom.llm.common import table
from feedloom.llm.exact_dedup import exact_dedup
from feedloom.llm.language_id import language_id
from feedloom.llm.mixing import mix_sources
from feedloom.llm.packing import pack
from feedloom.llm.pii import personal_data
from feedloom.llm.simhash_dedup import simhash_dedup
from feedloom.llm.suffix_dedup import suffix_dedup
from feedloom.llm.topk_search import top_k
from feedloom.llm.toxicity import toxicity
from feedloom.llm.url_filter import url_filter
from feedloom.llm.whitening import whiten

#: Where the vocabulary file lies on every machine.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
Query = Callable[[SparkSession, str], DataFrame]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"))


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_mix_sources": op2_mix_sources,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_toxicity": op4_toxicity,
    "op5_language_id": op5_language_id,
    "op6_personal_data": op6_personal_data,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_clustering": op12_clustering,
    "op13_topk_search": op13_topk_search,
}
