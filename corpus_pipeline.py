"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents its predecessor kept. The first four
return the columns of ``documents``, the last one the places of all pieces in sequences. What a stage
returns is written as Parquet and read again before the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cadastra.llm import capped_mixing, combination_join, compression_quality, linked_secrets, packing
from cadastra.llm.queries import prepared, table
from cadastra.sources.staging import stage

#: Near duplicates share four fifths of their runs of five words.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
KEEP_SCORE = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose compression score is at least :data:`KEEP_SCORE`; the model is fitted on the labels of ``sf_dir``."""
    model = compression_quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.where(compression_quality.quality_score(model, "text") >= KEEP_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of every group of linked documents; documents without words stay."""
    return combination_join.first_of_each_group(docs, n=SHINGLE_WORDS, percent=SIMILAR_PERCENT)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked; ``n_chars`` follows the text."""
    masked = linked_secrets.redacted(docs)
    return masked.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType)))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return capped_mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences."""
    return packing.pack_documents(docs)


def _stage(build: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return build(prepared(spark), docs, sf_dir.rstrip("/"))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    return run


STAGES = [(f.__name__, _stage(f)) for f in (quality, near_duplicates, secrets, mixture, packed)]

#: Compression, verification by set overlap and packing have no SQL; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir.rstrip("/"), "documents")
    for name, build in STAGES[:-1]:
        docs = stage(build(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
