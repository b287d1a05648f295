"""Token counts of whole texts, without keeping the tokens."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents
from .pieces import Pieces, slices


@lru_cache(maxsize=4)
def _counter(path: str) -> Pieces:
    """One per Python worker: it outlives the task, and so does its cache."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Pieces(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs``.

    ``tokenizer`` is a tokenizers ``.json`` or a sentencepiece ``.model`` file
    that every executor can read. No begin, end or padding tokens; strings of
    special tokens inside a text count as the library's default has them.
    Texts are handed to the library in batches balanced by bytes, and cut
    before a space between two other characters, where no token can span the cut.
    Needs no shuffle.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows stay repeated;
    an empty table gives an empty one; extra columns are left out.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for rows in batches:
            lengths = np.zeros(rows.num_rows, np.int64)
            at = 0
            for texts in slices(rows.column(1)):
                for which, keys, n_ids, _ in counter.encode(texts):
                    lengths[at + which] = keys.sums(n_ids)
                at += len(texts)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.array(lengths)], ["doc_id", "n_bytes", "n_tokens"])

    rows = documents(docs).select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.select("*", (F.col("n_tokens") > limit).alias("over_limit"))
