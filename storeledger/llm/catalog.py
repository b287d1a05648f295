"""The document queries over the driver's tables, with their SQL counterparts where SQL can express them."""

from __future__ import annotations

import public_tokenizers

from . import decontaminate, fingerprints, near_dedup, periodic_runs, pii_boosting, projection_neighbours, quality_crf, substring_dedup, suffix_dedup, token_counts, token_files, unigram, whitening
from .common import documents, read


def op1_sentencepiece_unigram(spark, sf_dir):
    return unigram.unigram_digest(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_quality_crf(spark, sf_dir):
    from pyspark.sql import functions as F

    docs = read(spark, sf_dir, "documents")
    chain = quality_crf.fit(docs, read(spark, sf_dir, "labels"))
    scored = quality_crf.quality_scores(documents(docs), chain)
    return scored.select("doc_id", quality_crf.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_token_files(spark, sf_dir):
    return token_files.token_files(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op4_benchmark_containment(spark, sf_dir):
    return decontaminate.contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents")).drop("kept")


def op6_personal_data(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return pii_boosting.personal_data(docs, pii_boosting.fit(docs))


def op7_near_duplicates(spark, sf_dir):
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op8_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


def op9_token_counts(spark, sf_dir):
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(read(spark, sf_dir, "documents")).drop("kept")


def op11_projection_neighbours(spark, sf_dir):
    return projection_neighbours.similar_vectors(read(spark, sf_dir, "embeddings"))


def op12_bit_sliced_whitening(spark, sf_dir):
    return whitening.whitened(read(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.periodic_runs(periodic_runs.with_repeats(read(spark, sf_dir, "documents"))).drop("runs", "collapsed")


QUERIES = {
    "op1_sentencepiece_unigram": (op1_sentencepiece_unigram, None),
    "op2_quality_crf": (op2_quality_crf, None),
    "op3_token_files": (op3_token_files, None),
    "op4_benchmark_containment": (op4_benchmark_containment, decontaminate.SQL),
    "op5_suffix_array_dedup": (op5_suffix_array_dedup, None),
    "op6_personal_data": (op6_personal_data, None),
    "op7_near_duplicates": (op7_near_duplicates, None),
    "op8_fingerprints": (op8_fingerprints, None),
    "op9_token_counts": (op9_token_counts, None),
    "op10_substring_dedup": (op10_substring_dedup, None),
    "op11_projection_neighbours": (op11_projection_neighbours, projection_neighbours.SQL),
    "op12_bit_sliced_whitening": (op12_bit_sliced_whitening, None),
    "op13_periodic_runs": (op13_periodic_runs, None),
}


def queries() -> dict:
    return {name: entry[0] for name, entry in QUERIES.items()}


def oracle_sql() -> dict:
    return {name: entry[1] for name, entry in QUERIES.items() if entry[1] is not None}
