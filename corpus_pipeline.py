"""A corpus from raw documents to a mix: each stage applies one operator to what the one before kept.

1 quality rules: documents that the rules reject go.
2 line dedup: later near copies of lines go from the texts; n_chars follows; rows stay.
3 n-gram Jaccard join: of each group of near copies the document with the least id stays.
4 benchmark decontamination: documents with a benchmark passage go.
5 mixing: how many words of each document the mix takes.

Columns of `docs` beyond those that a stage reads pass through stages 1 to 4; what each
operator does with nulls, empty texts, repeated rows and empty tables is in its module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, jaccard, line_dedup, mixing, quality
from tessera.llm.shared import cut, ready


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    rules = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select("text", F.struct("*").alias("__row"))  # the statistics' names may be columns of docs
    return quality.judge(rows, rules).filter("kept").select("__row.*")


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    out = line_dedup.remove(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return jaccard.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("ngram_jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
]

#: Learned rules, similarity joins and latent retrieval can't be said in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
