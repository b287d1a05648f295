"""Token ids as flat binary files.

A shard is three files: ``.ids`` (unsigned little-endian ids, 16 bits if the
vocabulary allows it, else 32), ``.off`` (64-bit token offsets of the shard's
documents, one more than documents) and ``.doc`` (64-bit document ids). Shards
follow the order of document ids; a shard's base in the corpus is the prefix
sum of the tokens before it and is kept in the manifest.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import unquote, urlparse
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, new_folder, staged
from .pieces import Pieces, slices

MANIFEST = "part int, path string, width int, n_docs long, n_nulls long, n_tokens long"


def _local(path: str) -> str | None:
    """The plain path if the folder is mounted, as file: paths are."""
    url = urlparse(path)
    return unquote(url.path) if url.scheme in ("", "file") else None


def _store(path: str) -> tuple[fs.FileSystem, str]:
    plain = _local(path)
    return (fs.LocalFileSystem(), plain) if plain is not None else fs.FileSystem.from_uri(path)


@lru_cache(maxsize=4)
def _encoder(path: str) -> Pieces:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Pieces(path)


def _width(tokenizer: str, *more: int) -> int:
    from tokenizers import Tokenizer

    largest = max(Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values(), default=0)
    return 2 if max(largest, *more) < 1 << 16 else 4


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None) -> DataFrame:
    """Encode whole texts, write shards in ascending ``doc_id`` order, return the manifest with each shard's base.

    One range shuffle of the texts; a task streams its range into one shard.
    File names are unique to the attempt and only shards in the manifest count,
    so a task that runs twice, after an executor is lost, does no harm.
    Null texts are empty, null ids come first, equal ids are ordered by text.
    """
    width = _width(tokenizer, end_id or 0)
    end = np.array([] if end_id is None else [end_id], f"<u{width}")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, offsets, ids, nulls = _encoder(tokenizer), array("q", [0]), array("q"), 0
        name = f"{folder}/shard-{uuid4().hex}"
        store, path = _store(name)
        store.create_dir(os.path.dirname(path), recursive=True)
        with store.open_output_stream(f"{path}.ids") as out:
            for rows in batches:
                nulls += rows.column(0).null_count
                ids.extend(rows.column(0).fill_null(0).to_pylist())
                for texts in slices(rows.column(1)):
                    coded: list = [None] * len(texts)
                    for which, keys, n_ids, flat in encoder.encode(texts):
                        joined, starts = keys.joined(n_ids, flat.astype(f"<u{width}"))
                        for k, row in enumerate(which):
                            coded[row] = joined[starts[k] : starts[k + 1]]
                    for part in coded:
                        out.write(part)
                        out.write(end)
                        offsets.append(offsets[-1] + len(part) + len(end))
        for ending, values in ((".off", offsets), (".doc", ids)):
            with store.open_output_stream(f"{path}{ending}") as out:
                out.write(np.asarray(values, "<i8").tobytes())
        if ids:
            row = [TaskContext.get().partitionId(), name, width, len(ids), nulls, offsets[-1]]
            yield pa.RecordBatch.from_pylist([dict(zip(("part", "path", "width", "n_docs", "n_nulls", "n_tokens"), row, strict=True))], schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_nulls", pa.int64()), ("n_tokens", pa.int64())]))

    ordered = documents(docs).repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    shards = staged(ordered.mapInArrow(write, MANIFEST), "token-shards")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    return shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _mapped(path: str, kind: str, scratch: str) -> np.ndarray:
    plain = _local(path)
    if plain is None:  # a remote store can't be mapped: map a passing copy
        store, remote = _store(path)
        plain = f"{scratch}/{os.path.basename(path)}"
        with store.open_input_stream(remote) as source, open(plain, "wb") as out:
            shutil.copyfileobj(source, out, 1 << 20)
    return np.memmap(plain, dtype=kind, mode="r") if os.path.getsize(plain) else np.empty(0, kind)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document ``doc_id, start, n_tokens, ids_crc32``, from the memory-mapped files.

    ``ids_crc32`` is taken over the ids as little-endian 32-bit integers, whatever
    width the files have.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for shard in rows.to_pylist():
                with tempfile.TemporaryDirectory() as scratch:
                    ids = _mapped(f"{shard['path']}.ids", f"<u{shard['width']}", scratch)
                    offsets = _mapped(f"{shard['path']}.off", "<i8", scratch)
                    docs = _mapped(f"{shard['path']}.doc", "<i8", scratch)
                    sums = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(docs), mask=np.arange(len(docs)) < shard["n_nulls"]),
                            pa.array(offsets[:-1] + shard["base"]),
                            pa.array(np.diff(offsets)),
                            pa.array(sums, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    shards = manifest.count()
    return manifest.repartition(max(1, shards), "part").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int | None = 1, folder: str | None = None) -> DataFrame:
    """Write the files below ``folder`` (by default a new shared one) and read them back."""
    spark: SparkSession = docs.sparkSession
    return read_token_files(write_token_files(docs, tokenizer, folder or new_folder(spark, "tokens"), end_id))
