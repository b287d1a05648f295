"""Raw capture files: bytes, manifest, checksum sidecars, product snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..errors import CaptureError
from .capture_files import read_capture_files

DATED_FOLDER = r"/(\d{4}-\d{2}-\d{2})/[^/]*$"


def folder_date(path: Column) -> Column:
    """The ``yyyy-MM-dd`` folder a file lies in, as text; null elsewhere."""
    return F.nullif(F.regexp_extract(path, DATED_FOLDER, 1), F.lit(""))


def read_captures(
    spark: SparkSession, root: str, name: str = "orders.csv", first: str | None = None, last: str | None = None,
    most_bytes: int | None = None,
) -> DataFrame:
    """Every ``<root>/<yyyy-MM-dd>/<name>`` from the day ``first`` to ``last``: path, length, content.

    Files of other days are not opened, and files above ``most_bytes`` have no content.
    """
    files = read_capture_files(spark, root, name, most_bytes)
    if first is not None:
        files = files.where(F.col("folder_date") >= first)
    if last is not None:
        files = files.where(F.col("folder_date") <= last)
    return files.select("path", "length", "content")


def manifest(files: DataFrame) -> DataFrame:
    """Hash and size of every file; the content itself is dropped."""
    return files.select(
        "path",
        folder_date(F.col("path")).alias("folder_date"),
        F.sha2("content", 256).alias("sha256"),
        F.length("content").cast("bigint").alias("file_size_bytes"),
    )


def read_sidecars(spark: SparkSession, root: str, name: str = "orders.csv") -> DataFrame:
    """Checksum sidecars: the first word of each, lower-cased; no rows if there are none."""
    try:
        text = spark.read.text(f"{root.rstrip('/')}/*/{name}.sha256", wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, recorded_sha256 string")
    text = text.select("value", F.col("_metadata.file_path").alias("sidecar_path"))
    return text.select(
        F.regexp_replace(F.regexp_replace("sidecar_path", r"\.sha256$", ""), "^file:/+", "/").alias("path"),
        recorded_hash(F.col("value")).alias("recorded_sha256"),
    )


def read_weather_payloads(spark: SparkSession, root: str) -> DataFrame:
    """Landed weather responses ``<root>/<date>/<store_id>.json``: store_id, date, payload."""
    text = spark.read.text(f"{root.rstrip('/')}/*/*.json", wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"))
    return text.select(
        F.regexp_replace("name", r"\.json$", "").alias("store_id"),
        F.try_to_date(folder_date(F.col("path")), "yyyy-MM-dd").alias("date"), F.col("value").alias("payload"))


def recorded_hash(text: Column) -> Column:
    """First word of a ``<hash>  <file>`` line."""
    return F.lower(F.regexp_extract(text, r"^\s*(\S+)", 1))


def sidecar_text(sha256: Column, name: str = "orders.csv") -> Column:
    return F.concat(sha256, F.lit(f"  {name}\n"))


def verify_checksums(files: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Compare recorded with computed hashes; files without a sidecar count as unrecorded."""
    return (
        files.join(sidecars, "path", "left")
        .withColumn(
            "checksum_state",
            F.when(F.col("recorded_sha256").isNull(), "unrecorded")
            .when(F.col("recorded_sha256") == F.lower("sha256"), "match")
            .otherwise("mismatch"),
        )
    )


def latest_complete_folder(files: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Newest dated folder holding every required file name, as one row.

    ``files`` has ``folder_date`` and ``file_name``. Only a bounded number of
    names is counted per folder, so the aggregate stays small.
    """
    present = [F.max(F.col("file_name") == name) for name in required]
    complete = present[0]
    for flag in present[1:]:
        complete = complete & flag
    return (
        files.where(F.col("folder_date").isNotNull())
        .groupBy("folder_date").agg(complete.alias("complete"))
        .where("complete")
        .agg(F.max("folder_date").alias("folder_date"))
    )


def read_latest_products(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Legacy and new products of the newest complete snapshot, all columns as text."""
    from .. import schemas

    names = ("products.csv", "new_products.csv")
    root = root.rstrip("/")
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*products.csv")
        .load(f"{root}/*").select(
            folder_date(F.col("path")).alias("folder_date"),
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
        )
    )
    newest = latest_complete_folder(listing, names).first()["folder_date"]
    if newest is None:
        raise CaptureError(f"No complete product snapshot holds {' and '.join(names)}.")
    return (
        read_text_csv(spark, f"{root}/{newest}/products.csv", schemas.LEGACY_PRODUCTS),
        read_text_csv(spark, f"{root}/{newest}/new_products.csv", schemas.NEW_PRODUCTS),
    )


def read_text_csv(spark: SparkSession, path, schema) -> DataFrame:
    """CSV with a header, every column read as declared; a BOM is ignored."""
    return (
        spark.read.schema(schema).option("header", True).option("quote", '"')
        .option("escape", '"').option("enforceSchema", False).csv(path)
    )
