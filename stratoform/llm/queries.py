"""One query per operator over the given tables, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratoform.llm import (
    decontaminate,
    divergence,
    exact,
    langid,
    mixing,
    negatives,
    pii,
    quality,
    simhash,
    substring,
    suffix_dedup,
    tokens,
    toxicity,
)
from stratoform.llm.sql import SQL

Build = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_collinear_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.passages(_table(spark, sf_dir, "documents"))


def op2_bilstm_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(pii.labelled_windows(docs)))


def op3_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(_table(spark, sf_dir, "documents"))


def op4_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judge(quality.ledger(_table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "fail_bits",
    )


def op5_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents")).drop("text_hash", "parts")


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(langid.is_training(F.col("doc_id"))))
    return langid.predict(docs, model).withColumn("held_out", ~langid.is_training(F.col("doc_id")))


def op7_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = ~toxicity.is_training(F.col("doc_id"))
    characters = toxicity.character_model(docs)
    scorer = toxicity.learn(characters, docs.where(~held_out), labels) if characters else None
    return toxicity.scores(docs, scorer).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(_table(spark, sf_dir, "documents"))


def op9_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, benchmark).drop("text_hash")


def op10_longest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(_table(spark, sf_dir, "documents"))


def op11_run_length_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_two_pass_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.copies(_table(spark, sf_dir, "documents"))


def op13_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the ids divisible by 100; every seventh row has a wrong label on purpose."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


QUERIES: dict[str, Build] = {
    f.__name__: f
    for f in (
        op1_collinear_chains,
        op2_bilstm_crf,
        op3_bk_trees,
        op4_rule_ledger,
        op5_sainte_lague,
        op6_kneser_ney,
        op7_noisy_channel,
        op8_prefix_doubling,
        op9_suffix_decontamination,
        op10_longest_match,
        op11_run_length_audit,
        op12_two_pass_bloom,
        op13_length_buckets,
    )
}


def all_queries() -> dict[str, tuple[Build, str | None]]:
    return {name: (build, SQL.get(name)) for name, build in QUERIES.items()}
