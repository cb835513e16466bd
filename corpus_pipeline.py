"""A training corpus from raw documents, in five stages over the operators of tapeworks.llm.

Each stage is a function of (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet in
the shared folder and read again as the next stage's documents. All but the last return the columns of
documents. Rows with null or empty texts fall to the quality rules; an empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tapeworks.llm.bpe_prefix import RANKS, encode_report
from tapeworks.llm.common import settle, table
from tapeworks.llm.divergence import keep_good
from tapeworks.llm.exact_heavy import drop_copies
from tapeworks.llm.minhash import drop_near
from tapeworks.llm.mixing import keep_mixed

# Target weights of the mix; nodes that aren't listed have weight 1. One epoch of 8 in 10 tokens.
WEIGHTS = {("web",): 4, ("books",): 3, ("reference",): 2, ("forum",): 2, ("web", "en"): 2, ("web", "en", "src0"): 2}
SHARE = 800


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near(docs, words=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_mixed(docs, WEIGHTS, SHARE)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_report(docs, public_tokenizers.path(RANKS))


STAGES = [
    ("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing),
    ("token_ids", token_ids),
]
ORACLE_SQL = None  # the quality and near-duplicate stages are not for SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
