"""A training-data pipeline over ``documents``: five stages, each over all rows that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows as Parquet into the
shared folder and reads them back for the next, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import common as C
from wordloom.llm import decontamination, langid, neardup, pieces, quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that policy v1 keeps. The measurements are made in the row itself, so no join is needed.

    A null or empty text has no words and goes; repeated rows are judged alike; columns keep their names, whatever these
    are; an empty table gives none.
    """
    measured = quality.measure(docs.select(F.struct(*docs.columns).alias("row"), "text"))
    entries = measured.select("row", quality.fail_bits().alias("fail_bits"))
    return entries.where(quality.failed(quality.POLICY_V1) == 0).select("row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models do not reject; learned from the labelled part of these documents.

    Nulls in other columns don't matter; a null language is not learned from; a null text, or one without a letter, goes;
    repeated rows are judged alike; an empty table, or one from which nothing can be learned, gives none.
    """
    return langid.filter_rows(docs, C.fold(F.col("doc_id"), 3) != 1).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id.

    Null ids come last, equal ids by the digest of their text, and of repeated rows one stays; null and empty texts are
    one class; an empty table gives none.
    """
    return neardup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark.

    A null or empty text has no words and stays; repeated rows are judged alike; an empty benchmark removes none.
    """
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean_rows(docs, bench).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document: piece ids and scores, with counts and checksums."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.segment(docs, path, k=2, seed=7, finish=pieces.checked(path), schema=f"{pieces.SAMPLES}, {pieces.DIGEST}")


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: Language models and near duplicates are not expressible. The operators' tests compare op1, op5 and op8 with plain
#: versions, and language models' cross-entropies; rejection is tested on left-out languages, sampled pieces on 40 texts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = C.Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
