"""The corpus pipeline: toxic documents go, near copies go, personal data is masked, the rest is packed.

``STAGES`` lists the stages in order; ``run`` applies them to ``documents``,
writing each stage's rows to the shared folder before the next one reads them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplens.llm.common import ship_package, stored
from shoplens.llm.ngram_join import near_duplicates
from shoplens.llm.packing import pack_documents
from shoplens.llm.pii import mask_documents
from shoplens.llm.toxicity import train_toxicity, with_toxicity


BROADCAST_IDS = 1_000_000  # two longs each


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain does not call toxic; learned from the table's labels.

    Every row is judged by its whole text alone: repeated rows and rows without
    an id alike; NULL and empty texts stay.  With clean labels alone, or none,
    all rows stay; with toxic labels alone none does, as every score is 1.
    Other columns pass through, whatever their names.
    """
    ship_package(spark)
    model = train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    prefix = "_toxicity_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    scored = with_toxicity(docs, model, prefix=prefix)
    return scored.filter(F.col(f"{prefix}score") < 0.5).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id (of its texts, the smallest hash).

    A document is an id and a text: other texts of the same id are judged by
    themselves, rows that repeat both count as one.  Rows without an id cannot
    be named and stay, as do empty texts.
    """
    ship_package(spark)
    groups = stored(near_duplicates(docs), "groups")
    named = groups.filter("doc_id IS NOT NULL AND component IS NOT NULL")
    # a group may hold several texts of its smallest id
    texts = named.filter("doc_id = component_id").select("component", "doc_id", "text_hash").distinct()
    first = Window.partitionBy("component").orderBy("text_hash")
    also = texts.withColumn("place", F.row_number().over(first)).filter("place > 1").select("doc_id", "text_hash")
    extra = named.filter("doc_id <> component_id").select("doc_id", "text_hash").unionByName(also).distinct()
    extra = extra.toDF("copy_id", "copy_hash")
    if extra.count() <= BROADCAST_IDS:  # else the texts are shuffled to meet the ids
        extra = F.broadcast(extra)
    is_copy = (docs["doc_id"] == extra["copy_id"]) & (F.xxhash64(docs["text"]) == extra["copy_hash"])
    kept = docs.join(extra, is_copy, "left_anti")
    repeated = groups.groupBy("doc_id", "text_hash").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    repeated = repeated.distinct()
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns)
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(once)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with each personal-data span replaced by its kind in brackets."""
    return mask_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, in sequences of 1024 tokens.

    A NULL or empty text is its end id alone; repeated rows, ties and rows
    without an id are packed row by row; longer documents are cut and lose
    nothing; an empty table gives no rows; other columns are not read.
    """
    ship_package(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# a trained chain, trained label weights and tokenizer merges are not SQL: tests/llm checks the rows
ORACLE_SQL = None
