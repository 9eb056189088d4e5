"""The operators as named queries over the given tables, with production parameters.

``ORACLE_SQL`` has DuckDB SQL for those that SQL can express; the others are
compared with brute-force versions in tests/llm.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.alignment import align_documents
from shoplens.llm.common import ship_package
from shoplens.llm.fingerprints import fingerprint_documents
from shoplens.llm.html_main import extract_main_text
from shoplens.llm.merge_dropout import encode_and_decode
from shoplens.llm.ngram_join import near_duplicates
from shoplens.llm.norm_topk import top_k
from shoplens.llm.oracle import ORACLE_SQL
from shoplens.llm.orc_ids import orc_token_ids
from shoplens.llm.packing import pack_documents
from shoplens.llm.pii import find_personal_data
from shoplens.llm.sharding import shard_documents
from shoplens.llm.token_counts import count_tokens
from shoplens.llm.toxicity import score_documents
from shoplens.llm.whitening import whiten

__all__ = ["ORACLE_SQL", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op3_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary, end_id=2, capacity=1024)


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op7_norm_bucket_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=40)


def op10_orc_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return orc_token_ids(table(spark, sf_dir, "documents"), vocabulary, end_id=1)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align_documents(table(spark, sf_dir, "documents"), a, b)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whiten(table(spark, sf_dir, "embeddings"), components=4, scale=256)
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_order_minhash,
        op2_personal_data,
        op3_merge_dropout,
        op4_html_main_text,
        op5_best_fit_packing,
        op6_ngram_jaccard_join,
        op7_norm_bucket_topk,
        op8_toxicity,
        op9_hypergeometric_shards,
        op10_orc_token_ids,
        op11_token_counts,
        op12_token_alignment,
        op13_whitening,
    )
}
