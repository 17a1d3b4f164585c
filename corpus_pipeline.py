"""Cleaning, deduplicating, decontaminating and mixing `documents`, stage by stage.

Every stage but the last returns the rows of its input that stay, with all their columns; the last returns one row per
document that is left, saying how many of its words the mix takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.functions.session import new_path
from sheafline.llm import leaks, mixing, omh, quality, toxicity
from sheafline.llm.passing import quoted


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the limit."""
    index = toxicity.train(docs, _labels(spark, sf_dir))
    scored = toxicity.score(docs, index, keep=docs.columns, prefix="__toxic_")
    return scored.where(F.col("__toxic_score") < toxicity.THRESHOLD).select(*map(quoted, docs.columns))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are sound more likely than not."""
    model = quality.train(docs, _labels(spark, sf_dir), quality.grade_of(F.col("quality"), F.col("toxic")))
    scored = quality.score(docs, model, keep=docs.columns, prefix="__quality_")
    return scored.where(F.col("__quality_tail_probability") >= quality.SELECT).select(*map(quoted, docs.columns))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return omh.deduplicated(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    groups = leaks.build(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    scanned = leaks.scan(docs, groups, keep=docs.columns, leaks="__leaks_found")
    return scanned.where(F.size("__leaks_found") == 0).select(*map(quoted, docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mix(docs)["documents"]


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_dedup", drop_copies),
          ("decontamination", drop_leaks), ("mixing", mix_sources)]
ORACLE_SQL = None  # learnt models, alignments and hashes are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage works on all that the one before kept, written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = new_path(spark, "stage")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
