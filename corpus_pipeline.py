"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

Quality: documents that the classifier rejects go. Near duplicates: one document of
each group stays. Decontamination: contaminated documents go. Secrets: they are
replaced in the texts by their kind. Mixing: the last stage says how often each
document is taken.

Executors keep their JVM and Python workers from stage to stage, so every stage that
maps texts in Python bounds its batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import decontaminate, quality_classifier, secret_scan, shingle_join, source_mix
from recordloom.llm.common import materialize, small_batches, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6. The model is fitted on labelled texts of ``docs``."""
    small_batches(spark)
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.drop_rejected(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5 by shingle sets: five words, linked from a Jaccard of 0.8 on."""
    small_batches(spark)
    return shingle_join.drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8, by its contamination rule."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9. ``n_chars``, where there is one, follows the new text."""
    small_batches(spark)
    hidden = secret_scan.redacted(docs)
    if "n_chars" in docs.columns:
        hidden = hidden.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))
    return hidden.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: ``doc_id, size, source_size, target, taken``."""
    return source_mix.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("secrets", secrets),
    ("mixing", mixing),
]

#: Neither fitted classifiers nor near-duplicate components are SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
