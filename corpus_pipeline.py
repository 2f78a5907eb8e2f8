"""From raw documents to token ids: five stages, each written and read again before the next.

toxicity: documents that score 0.5 or more go. near_dedup: of documents linked at a similarity of 0.80 or more the
one with the smallest doc_id stays. substring_dedup: repeated passages are cut out of the texts. mixing: documents
are repeated or left out until sources stand at their target weights. bpe: every remaining text is encoded and
decoded.

Defined results, besides those of the operators: null and empty texts pass through the first three stages and fall
to no source's share in the mix; very long texts pass whole; rows that share a doc_id or have none count each by
itself, so repeated rows are near copies of which one stays; ties go to the smallest doc_id; extra columns pass
through to the last stage, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from granary.llm import bpe, minhash, mixing, substring, toxicity
from granary.llm.shared import keep


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(docs)


STAGES = [("toxicity", drop_toxic), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("mixing", mix_sources), ("bpe", encode)]
ORACLE_SQL = None  # learnt weights, links and tokens are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
