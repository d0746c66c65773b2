"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assaylake.llm.common import table
from assaylake.llm.cover_tree import mine
from assaylake.llm.cuckoo_lines import dedupe_lines
from assaylake.llm.decontaminate import leaks
from assaylake.llm.hilbert import shard
from assaylake.llm.html_mss import extract
from assaylake.llm.importance import resample
from assaylake.llm.oph import fingerprint_edits
from assaylake.llm.packing import pack
from assaylake.llm.simhash import simhash_groups
from assaylake.llm.sum_of_squares import pack_online
from assaylake.llm.token_counts import token_lengths
from assaylake.llm.toxicity import toxicity
from assaylake.llm.value_dictionaries import compress


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_lengths(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_max_scoring_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op7_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op8_one_permutation_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op9_cuckoo_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_lines(table(spark, sf_dir, "documents")).drop("text")


def op10_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_online(table(spark, sf_dir, "documents"))


def op12_cover_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))


def op13_value_dictionaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_template_decontamination": op3_template_decontamination,
    "op4_simhash_pigeonring": op4_simhash_pigeonring,
    "op5_importance_resampling": op5_importance_resampling,
    "op6_max_scoring_html": op6_max_scoring_html,
    "op7_hilbert_sharding": op7_hilbert_sharding,
    "op8_one_permutation_minhash": op8_one_permutation_minhash,
    "op9_cuckoo_line_dedup": op9_cuckoo_line_dedup,
    "op10_subword_toxicity": op10_subword_toxicity,
    "op11_sum_of_squares_packing": op11_sum_of_squares_packing,
    "op12_cover_tree_negatives": op12_cover_tree_negatives,
    "op13_value_dictionaries": op13_value_dictionaries,
}
