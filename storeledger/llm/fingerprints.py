"""Document fingerprints by consistent weighted sampling, next to those of an edited text."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents
from .pieces import slices
from .sampling import WORDS, blocks, keyed_samples, likeness, seeds, shingle_hashes, signature, word_hashes

SAMPLES = 64
#: Bytes of text in a range of ids, and the most ranges; with more text, ranges get larger.
RANGE_BYTES = 4 << 20
MOST_RANGES = 20_000
#: Sampled terms of one text that are kept while its edited text is sampled.
MOST_KEYED = 1 << 21
_NONE = -(1 << 63)


def terms(words: np.ndarray, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of a text and how often each occurs."""
    return np.unique(shingle_hashes(words, width), return_counts=True)


def fingerprint(text: str, samples: int = SAMPLES, width: int = WORDS) -> str:
    """Of one text, in hexadecimal."""
    words, _ = word_hashes([text])
    return blocks(*terms(words, width), seeds(samples)).astype(">u4").tobytes().hex()


def in_id_ranges(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows dealt by ranges of ``doc_id`` and sorted, each range followed by the document that comes after it.

    Columns ``range, passing, doc_id, text``. A ``passing`` row is a copy of the first row of the
    next range that holds any (of the first range, for the last): with it, each document's
    successor stands in its own partition. Ranges are cut at quantiles of the ids; the driver sees
    two numbers a range. One shuffle of the texts.
    """
    spark = docs.sparkSession
    rows = documents(docs)
    value = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    n_bytes = rows.agg(F.sum(F.octet_length("text") + 16).cast("long")).first()[0] or 0
    n_ranges = min(MOST_RANGES, math.ceil(n_bytes / range_bytes) or 1)
    shares = [k / n_ranges for k in range(1, n_ranges)]
    cuts = rows.where("doc_id is not null").approxQuantile("doc_id", shares, 0.1 / n_ranges) if shares else []
    bucketizer = Bucketizer(splits=[float("-inf"), *sorted(set(cuts) or [0.0]), float("inf")], inputCol="value", outputCol="bucket")

    def ranged(part: DataFrame) -> DataFrame:
        return bucketizer.transform(part.withColumn("value", value)).withColumn("range", F.col("bucket").cast("int")).drop("value", "bucket")

    least = F.min(F.coalesce("doc_id", F.lit(_NONE))).alias("first")
    firsts = sorted(tuple(r) for r in ranged(rows.select("doc_id")).groupBy("range").agg(least).collect())
    follows = [(firsts[k][1], firsts[k - 1][0]) for k in range(len(firsts))]  # of the first range, the last comes before
    links = spark.createDataFrame(follows, "first long, before int")
    marked = ranged(rows).join(F.broadcast(links), F.coalesce("doc_id", F.lit(_NONE)) == F.col("first"), "left")
    own = F.struct(F.col("range"), F.lit(False).alias("passing"))
    copy = F.struct(F.col("before").alias("range"), F.lit(True).alias("passing"))
    dealt = marked.select(F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("at"), "doc_id", "text")
    dealt = dealt.select("at.range", "at.passing", "doc_id", "text")
    return dealt.repartition(max(1, math.ceil(n_ranges / 2)), "range").sortWithinPartitions("range", "passing", F.col("doc_id").asc_nulls_first(), "text")


def fingerprints(docs: DataFrame, samples: int = SAMPLES, width: int = WORDS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per row of ``docs`` the fingerprints of its text and of its edited text, and how alike they are.

    The edited text has its last quarter replaced by as many characters from the beginning of the
    next document, by ascending id (null first, equal ids by text, after the last the first). Terms
    are shingles of ``width`` words weighted by their counts. ``near_edited`` and ``near_next`` are
    the shares of equal samples with the edited text and with the next document.

    Null texts are empty; empty texts share a fingerprint and are alike. Repeated rows stay
    repeated, each being the next of the one before. A table of one row follows itself; an
    empty table gives an empty one; extra columns are left out.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed = seeds(samples)

        def finish(row: tuple, following: tuple) -> tuple:
            """``row`` and ``following`` are (range, passing, doc_id, text, terms, counts, keyed, signature)."""
            text, shingles, counts, keyed, own = row[3:]
            cut = len(text) // 4
            edited = text[: len(text) - cut] + following[3][:cut]
            new, new_counts = terms(word_hashes([edited])[0], width)
            if keyed is None or not len(shingles):
                other = blocks(new, new_counts, seed)
            else:  # most terms are the text's own and have been sampled
                at = np.minimum(np.searchsorted(shingles, new), len(shingles) - 1)
                kept = (shingles[at] == new) & (counts[at] == new_counts)
                fresh = keyed_samples(new[~kept], new_counts[~kept], seed)
                other = signature(np.vstack([keyed[at[kept]], fresh]))
            return (
                row[2], len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own.astype(">u4").tobytes().hex(),
                other.astype(">u4").tobytes().hex(), likeness(own, other), likeness(own, following[7]),
            )

        last = None
        for rows in batches:
            out, at = [], 0
            for some in slices(rows.column(3), 1 << 19):
                texts = some.to_pylist()
                words, of_text = word_hashes(texts)
                for k, text in enumerate(texts):
                    shingles, counts = terms(words[of_text[k] : of_text[k + 1]], width)
                    keyed = keyed_samples(shingles, counts, seed) if len(shingles) * samples <= MOST_KEYED else None
                    own = blocks(shingles, counts, seed) if keyed is None else signature(keyed)
                    here = (*(rows.column(c)[at + k].as_py() for c in range(3)), text, shingles, counts, keyed, own)
                    if last is not None and not last[1] and last[0] == here[0]:
                        out.append(finish(last, here))
                    last = here
                at += len(texts)
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], names)

    ddl = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_id_ranges(docs, range_bytes).mapInArrow(sample, ddl)
