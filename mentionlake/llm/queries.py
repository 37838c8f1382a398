"""The operators as registered queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.llm import (
    decontaminate, licenses, mixing, near_dups, quality, resampling, substrings, surrogates, token_counts, token_files, toxicity, warc,
    whitening,
)
from mentionlake.llm.stage import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = quality.judged(docs, table(spark, sf_dir, "labels"))
    m = F.col("quality_measures")
    counts = [m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return rows.select(
        "doc_id", *counts, F.coalesce(F.col("quality_rule") == 0, F.lit(False)).alias("base_failed"),
        F.col("quality_kept").alias("kept"), F.col("quality_rule").alias("rule"),
    )


def op2_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digests(table(spark, sf_dir, "documents"), tokenizer())


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.drop("hits")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_plan(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).drop("url", "payload")


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get("spark.mentionlake.surrogateKey", "production key")
    return surrogates.replaced(table(spark, sf_dir, "documents"), key)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A cache of its own for each run, so that the work shown is that of the whole table.
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer(), new_folder(spark, "token-cache"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.drop("n_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_near_dups": op2_near_dups,
    "op3_token_files": op3_token_files,
    "op4_licenses": op4_licenses,
    "op5_decontaminate": op5_decontaminate,
    "op6_mix": op6_mix,
    "op7_warc": op7_warc,
    "op8_surrogates": op8_surrogates,
    "op9_toxicity": op9_toxicity,
    "op10_substrings": op10_substrings,
    "op11_whitening": op11_whitening,
    "op12_token_counts": op12_token_counts,
    "op13_resampling": op13_resampling,
}
