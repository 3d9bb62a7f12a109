"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textvec.llm import (
    angular,
    chat,
    cover_tree,
    decontaminate,
    knn_quality,
    line_dedup,
    packing,
    parsing,
    periodic,
    ppm,
    quality_rules,
    secrets,
    simhash,
)
from textvec.llm.common import table


def op1_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"), ppm.held_out())


def op3_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_quality.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def op5_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.without_repeats(table(spark, sf_dir, "documents"))


def op6_deletion_neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_digest(table(spark, sf_dir, "documents"))


def op8_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(table(spark, sf_dir, "conversations"))


def op9_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.default_tokenizer())


def op10_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", label)
    return angular.hard_negatives(vectors.where("vec_id % 100 = 0"), vectors)


def op12_recursive_splitting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(table(spark, sf_dir, "documents"), periodic.words_with_planted_tail)


def op13_cover_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return cover_tree.top_products(vectors.where("vec_id % 100 = 0"), vectors)
