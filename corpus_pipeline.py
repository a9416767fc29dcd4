"""The corpus pipeline: quality, language, near duplicates, benchmark passages, source mix.

Each stage takes what the stage before it kept, as written to Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.llm import decontaminate, langid, mixing, neardup, quality
from terraloom.llm.runtime import Scratch, free_name
from terraloom.llm.sampling import crc_mod

#: The stages are trained models and searches that SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated quality is 0.7 or more; all of them if there is nothing to learn from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    train = labels.where(crc_mod("doc_id", 4) != 2).select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    model = quality.fit(docs, train)
    if model.constant is not None:
        return docs
    name = free_name(docs, "__score")
    return quality.score(docs, model, name=name, keep_text=True).where(F.col(name) >= 0.7).drop(name)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learnt language; those without a letter and those that are ambiguous go."""
    train = docs.where(crc_mod("doc_id", 3) != 1).select(F.col("doc_id").alias("id"), F.col("lang").alias("label"))
    model = langid.fit(docs, train)
    if not model.langs:
        return docs
    lang, score, ambiguous = names = tuple(free_name(docs, n) for n in ("__lang", "__score", "__ambiguous"))
    said = langid.predict(docs, model, names=names, keep_text=True)
    return said.where((F.col(lang) != langid.UND) & ~F.col(ambiguous)).drop(lang, score, ambiguous)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are linked at a similarity of 0.8 or more."""
    return neardup.keep_one(docs, neardup.NearDupParams(width=5))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix_report(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources to target weights", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents below sf_dir."""
    docs, tmp = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = tmp.write(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            tmp.drop(f"stage-{k - 1}")
    return docs
