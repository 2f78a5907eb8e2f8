"""The registered opN queries: each applies its operator to its whole table and returns the contract's digest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import bpe_round_trip
from .chat import chat_format
from .forest import near_vectors
from .minhash import near_duplicates
from .mixing import mixing
from .oracles import ORACLES
from .pii import pii
from .pivots import top_k
from .quality import quality
from .rank import rank_documents
from .repair import structure_repair
from .substring import removed
from .toxicity import toxicity
from .wavelet import token_output


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents"))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format(table(spark, sf_dir, "conversations"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing(table(spark, sf_dir, "documents"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair(table(spark, sf_dir, "conversations"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(table(spark, sf_dir, "documents"))


def op13_lexical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_near_dedup": op2_near_dedup,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_token_output": op4_token_output,
        "op5_chat_format": op5_chat_format,
        "op6_mixing": op6_mixing,
        "op7_exact_top_k": op7_exact_top_k,
        "op8_near_vectors": op8_near_vectors,
        "op9_bpe": op9_bpe,
        "op10_toxicity": op10_toxicity,
        "op11_structure_repair": op11_structure_repair,
        "op12_pii": op12_pii,
        "op13_lexical_rank": op13_lexical_rank,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
