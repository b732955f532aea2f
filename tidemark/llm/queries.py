"""One query per training-data operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import documents
from tidemark.llm.decontam import find_leaks
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.html_extract import extract_main_text
from tidemark.llm.packing import pack
from tidemark.llm.pii import find_pii
from tidemark.llm.secrets import find_secrets
from tidemark.llm.simhash import simhash_groups
from tidemark.llm.substring_dedup import substring_dedup
from tidemark.llm.suffix_dedup import suffix_dedup
from tidemark.llm.toxicity import score_toxicity


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_toxicity, op3_decontamination, op4_html_extraction, op5_packing, op6_pii, op7_simhash, op8_substring_dedup, op9_secrets, op10_exact_dedup)}
