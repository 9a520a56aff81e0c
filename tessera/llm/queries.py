"""The contract's queries over the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.shared import ready, spread_out


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ready(spark)
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spread_out(rows) if table == "documents" else rows


def fold(n: int, doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n))


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import lm

    docs = read(spark, sf_dir, "documents")
    return lm.score(docs, fold(7) == 2)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import quality

    docs = read(spark, sf_dir, "documents")
    rules = quality.learn(docs, read(spark, sf_dir, "labels"))
    return quality.judge(docs.select("doc_id", "text"), rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import jaccard

    return jaccard.classes(read(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import decontaminate

    return decontaminate.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import toxicity

    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), fold(3) != 1)
    return toxicity.score(docs, model).select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "score", "predicted", "n_sentences", "worst_sentence", "worst_score")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import licenses

    found = licenses.scan(read(spark, sf_dir, "documents"))
    return found.withColumn("licenses", F.concat_ws(",", "licenses"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import line_dedup

    return line_dedup.report(read(spark, sf_dir, "documents")).withColumn("kept_lines", F.concat_ws(",", F.col("kept_lines").cast("array<string>")))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import substring_dedup

    return substring_dedup.remove(read(spark, sf_dir, "documents"), length=35)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tessera.llm import token_counts

    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import mixing

    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def lm_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op1 SQL can say."""
    return op1_lm_scores(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op2 SQL can say."""
    from tessera.llm import quality

    return quality.describe(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "stats")


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op10 SQL can say."""
    from tessera.llm import mixing

    sizes = read(spark, sf_dir, "documents").select("source", mixing.words("text").alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    return mixing.targets(sizes).select("source", "source_size", F.round("target", 4).alias("target"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_lm_scores, op2_quality_rules, op3_jaccard_join, op4_decontaminate, op5_toxicity, op6_licenses, op7_line_dedup, op8_substring_dedup, op9_token_counts, op10_mixing, pipeline, lm_base, quality_base, mixing_targets)}


def oracle_sql() -> dict[str, str]:
    from tessera.llm import licenses, oracles

    return {"op3_jaccard_join": oracles.JACCARD, "op6_licenses": licenses.oracle(), "op7_line_dedup": oracles.LINES, "op8_substring_dedup": oracles.substrings(), "lm_base": oracles.LM_BASE, "quality_base": oracles.QUALITY_BASE, "mixing_targets": oracles.TARGETS}
