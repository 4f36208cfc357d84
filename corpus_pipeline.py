"""Training-data pipeline: quality, near-duplicates, benchmark passages, personal data, source mix.

Every stage takes (spark, docs, folder of the tables), works on all rows its predecessor kept
and returns the columns of ``documents``; the last adds ``taken``, the words the mix takes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide.llm import decontaminate, mixing, neardup, pii, quality
from tallytide.llm.common import free_name, ready, table
from tallytide.scale import shared_folder

NEAR_PERCENT = 80  # texts are near-duplicates from this similarity of their shingle sets on


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the quality classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near-duplicates stays, the one with the smallest id. Rows with a NULL id stay."""
    verdicts = neardup.near_duplicates(docs, percent=NEAR_PERCENT).filter("not kept").select("doc_id").distinct()
    return docs.join(verdicts, "doc_id", "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a passage of a benchmark item go."""
    marked = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return marked.filter(F.size("hit_items") == 0).select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the text."""
    name = free_name(docs.columns, "_pii")
    found = pii.find_pii(docs, name=name, redact=True)
    chars = F.when(F.size(name) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.withColumn("n_chars", chars).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the mix takes, with ``taken`` words of each."""
    return mixing.mix(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
]

ORACLE_SQL = None  # the stages for quality, near-duplicates and personal data have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every result is written to the shared folder and read again."""
    ready(spark)
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
