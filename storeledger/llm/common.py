"""Helpers shared by the document operators."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder
from ..staging import staged
from .pieces import sliced

__all__ = ["components", "documents", "free_name", "new_folder", "read", "shuffles_deleted", "staged", "text_of", "with_columns"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def documents(docs: DataFrame) -> DataFrame:
    """The two columns operators work on; extra columns, whatever their names, are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def free_name(df: DataFrame, base: str) -> str:
    """A column name the frame does not have yet, in any letter case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def with_columns(docs: DataFrame, new: str, compute: Callable[[], Callable[[pa.Array], list[pa.Array]]]) -> DataFrame:
    """``docs`` with the columns of the DDL ``new``, computed from the texts, Arrow batch by Arrow batch.

    ``compute`` is called once in each task and gives the function over texts. All
    other columns pass through; a new name that is taken gets underscores.
    """
    text = free_name(docs, "text_in")
    schema = T.StructType(list(docs.schema.fields))
    added = len(T.StructType.fromDDL(new).fields)
    for field in T.StructType.fromDDL(new).fields:
        name, taken = field.name, {x.name.lower() for x in schema.fields}
        while name.lower() in taken:
            name += "_"
        schema = T.StructType([*schema.fields, T.StructField(name, field.dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over = compute()
        for rows in sliced(batches, len(schema.names) - added):
            columns = rows.columns[:-1] + over(rows.column(rows.num_columns - 1))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.withColumn(text, text_of()).mapInArrow(run, schema)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that driver and executors share."""
    return f"{shared_folder(spark)}/storeledger/{label}-{uuid4().hex}"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files go when the query has ended, not when the driver happens to collect its garbage.

    For a job of many written steps: no later step reads them, and so they need not add up on the disks.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


#: Edges that are worth a task of their own.
EDGES_A_TASK = 1 << 17


def _in_few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about so many ``rows``, in no more tasks than they are worth; as it is if shuffles have no more anyway.

    Of small tables a task for each shuffle partition costs far more, in time and in files, than its rows do.
    """
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(rows / EDGES_A_TASK))
    return df.coalesce(tasks) if tasks < int(spark.conf.get("spark.sql.shuffle.partitions")) else df


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, root)``, root being the least node.

    Alternates large-star and small-star steps (Kiveris et al., 2014): every step
    is one grouping, edges never multiply, and a round writes its edges to the
    shared folder, so lost executors cost one round at most. Groups are only
    folded to their minimum; no neighbourhood is gathered in one task. A round over
    few edges has few tasks, whatever the number of shuffle partitions.
    """
    pairs = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before, n = None, pairs.count()
    for _ in range(rounds):
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _in_few_tasks(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), n)
        large = _in_few_tasks(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"), n)
        least = _in_few_tasks(large.groupBy("u").agg(F.min("v").alias("m")), n)
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
        )
        pairs = staged(_in_few_tasks(_in_few_tasks(small, n).distinct(), n), "edges")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            roots = _in_few_tasks(pairs.groupBy("u").agg(F.min("v").alias("root")), n)
            return roots.select(F.col("u").alias("node"), "root").unionByName(
                _in_few_tasks(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct(), n)
            )
        before, n = now, now[0]
    raise RuntimeError(f"Components did not settle in {rounds} rounds.")
