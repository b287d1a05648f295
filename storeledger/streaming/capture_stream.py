"""Idempotent daily capture as a file stream.

The checkpoint lists each landed file once; the capture store and the audit log
are keyed, so a batch that runs again after a failure adds nothing twice.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.capture import run_ingestion
from ..schemas import AUDIT_LOG
from ..sinks.files import append_audit

BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def landed_files(spark: SparkSession, root: str, name: str = "orders.csv",
                 files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.format("binaryFile").schema(BINARY)
        .option("pathGlobFilter", name).option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch).load(root)
        .select("path", "length", "content")
    )


def take_in(files: DataFrame, store: str, log: str, checkpoint: str, now=None) -> None:
    """Preserve and log every capture of a stream of files, then stop."""
    def each_batch(batch: DataFrame, _: int) -> None:
        run_ingestion(batch, store, log, now() if now else datetime.now(timezone.utc))

    query = (
        files.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def capture_stream(
    spark: SparkSession, root: str, store: str, log: str, checkpoint: str,
    name: str = "orders.csv", now=None,
) -> None:
    """Take in everything landed so far under ``root``."""
    take_in(landed_files(spark, root, name), store, log, checkpoint, now)


def audit_stream(source: DataFrame, folder: str, checkpoint: str) -> None:
    """Append each event of a stream of audit rows once, then stop.

    The log itself tells what has passed: each batch meets the months it touches. So there is no
    state that grows, no event comes too late, and a batch that runs again adds nothing.
    """
    def each_batch(batch: DataFrame, _: int) -> None:
        append_audit(batch, folder)

    events = source.select(*[F.coalesce(c, F.lit("")).alias(c) for c in AUDIT_LOG.names])
    query = (
        events.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
