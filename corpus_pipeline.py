"""From documents to token ids: quality, near copies, benchmark passages, personal data, encoding.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame with the columns of documents; the
last adds ``ids`` and ``decoded``. Stages work on any frame with ``doc_id`` and ``text``; other
columns pass through, null texts count as empty, and an empty frame gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from storeledger.llm import decontaminate, near_dedup, pii_boosting, quality_crf, unigram
from storeledger.llm.common import read, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose lines the random field takes for bad."""
    return quality_crf.keep_good(docs, quality_crf.fit(docs, read(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of every near-duplicate class."""
    return near_dedup.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a test item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts."""
    return pii_boosting.redact_documents(docs, pii_boosting.fit(docs))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the piece ids of each text, and the text they decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return unigram.encode(docs, model, "ids", "decoded")


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("benchmark_passages", benchmark_passages),
    ("personal_data", personal_data),
    ("pieces", pieces),
]

#: SQL can express neither the trained stages nor the encoding; the tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
