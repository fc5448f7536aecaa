"""Corpus pipeline: documents through five stages, each written as Parquet and read again.

1. language: documents that language identification rejects (``und``: NULL, or without a letter) go;
2. near_copies: of each component of the n-gram Jaccard join one document stays; op8_jaccard's
   contract is applied (4 words, 0.85), not 5 words and 0.8;
3. decontaminate: documents that contain enough of a benchmark item go;
4. pii: personal data are replaced by format-preserving pseudonyms;
5. mix: documents are drawn by probabilities calibrated to target shares.

Stages 1 to 4 return the columns of ``documents``, stage 5 adds each document's probability and
weight. Null and empty texts, repeated rows, NULL ids and further columns are handled as each
operator's docstring says; an empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm import decontaminate, jaccard, language, mixing, pii
from voltframe.llm.common import bounded_batches, cut_lineage, table


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return language.keep_identified(docs, language.fit(language.training_rows(docs)))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return jaccard.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str, key: bytes = pii.KEY) -> DataFrame:
    """Text replaced under ``key``; ``n_chars``, where there is one, follows a changed length."""
    bounded_batches(spark)
    was = docs.withColumn("_voltframe_length", F.length("text"))
    out = pii.pseudonymise(was, key, prefix="_voltframe_")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.length("text") != F.col("_voltframe_length"), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*[f"`{c}`" for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return mixing.sample(docs)


STAGES = [
    ("language", identified),
    ("near_copies", without_near_copies),
    ("decontaminate", decontaminated),
    ("pii", pseudonymised),
    ("mix", mixed),
]

#: SQL cannot express the classifier or the permutation; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, key: bytes = pii.KEY) -> DataFrame:
    """The mixed corpus. ``key`` decides the pseudonyms; whoever has it can reverse them. The default is the
    public key of the checks: give your own for data that leave your hands."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        keyed = {"key": key} if name == "pii" else {}
        docs = cut_lineage(stage(spark, docs, sf_dir, **keyed), f"stage-{name}")
    return docs
