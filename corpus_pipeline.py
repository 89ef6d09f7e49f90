"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

quality      documents whose quality score is below 0.5 go
exact        of texts equal but for white space, the longest (then smallest id) stays
near         of each class of near copies, the smallest id stays
benchmark    documents that contain a benchmark window go
pack         the rest is cut into pieces and packed into sequences of 1024 tokens

Every stage but the last returns the columns of its input. ``run`` writes each stage's result as
Parquet under the shared checkpoint folder and reads it back for the next one, so a lost
executor costs a part of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from souk.llm import decontaminate, exact_dedup, near_dedup, packing, quality
from souk.llm.common import read_table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("exact", exact_stage),
    ("near", near_stage),
    ("benchmark", benchmark_stage),
    ("pack", pack_stage),
]

#: Classifier, components and tokenizer are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
