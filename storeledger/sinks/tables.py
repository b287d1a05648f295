"""Table outputs: publish with parity, insert if absent, create if missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import QualityError
from ..frames import side_by_side
from ..operators.weather import rows_to_insert
from ..schemas import WEATHER


def create_if_missing(spark: SparkSession, name: str, schema=WEATHER, path: str | None = None) -> None:
    """A parquet table with the given schema; key uniqueness is kept by the writers."""
    where = f" LOCATION '{path}'" if path else ""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")


def insert_if_absent(fetched: DataFrame, table: str) -> int:
    """Append rows whose key the table lacks; returns how many.

    The fresh rows are written to a staged table first, so that the target is
    not read while it is being written.
    """
    from ..staging import staged

    spark = fetched.sparkSession
    fresh = staged(rows_to_insert(fetched, spark.table(table)), "weather-insert")
    added = fresh.count()
    if added:
        fresh.select(*spark.table(table).columns).write.insertInto(table)
    return added


def replace_table(df: DataFrame, name: str, path: str | None = None, jdbc: dict | None = None) -> None:
    """Replace a catalog table, or a JDBC table with batched inserts."""
    if jdbc:
        df.write.mode("overwrite").format("jdbc").options(**jdbc).option("dbtable", name).option(
            "batchsize", 1000).save()
    else:
        writer = df.write.mode("overwrite").format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(name)


def row_parity(source: DataFrame, published: DataFrame) -> DataFrame:
    """Row counts of what was to be published and what the sink now holds."""
    count = F.count(F.lit(1))
    return (
        side_by_side(source.agg(count.alias("source_rows")), published.agg(count.alias("sql_rows")))
        .withColumn("sql_csv_row_count_difference", F.col("sql_rows") - F.col("source_rows"))
        .withColumn("validation_passed", F.col("sql_csv_row_count_difference") == 0)
    )


def require_parity(parity: DataFrame) -> None:
    if not parity.first()["validation_passed"]:
        raise QualityError("SQL and CSV row counts do not match.", parity)
