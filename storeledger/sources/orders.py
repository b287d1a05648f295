"""Order CSV scan across drifting headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import LEGACY_KEY, MIGRATED_KEY
from ..errors import CaptureError
from ..operators.capture_rules import capture_lines, field
from .capture_files import list_captures
from .captures import read_captures

# The columns of landed order lines.
BRONZE_COLUMNS = (
    "order_id", "order_date", "store_id", "product_id", "new_product_id",
    "quantity", "unit_price", "discount_pct", "sales_channel", "loyalty_member",
)


def union_variants(*frames: DataFrame) -> DataFrame:
    """Union frames of either header variant; the key a frame lacks is null."""
    aligned = []
    for frame in frames:
        for key in (LEGACY_KEY, MIGRATED_KEY):
            if key not in frame.columns:
                frame = frame.withColumn(key, F.lit(None).cast("string"))
        aligned.append(frame.select(*BRONZE_COLUMNS))
    result = aligned[0]
    for frame in aligned[1:]:
        result = result.unionByName(frame)
    return result


def read_orders(
    spark: SparkSession, root: str, name: str = "orders.csv", first: str | None = None, last: str | None = None
) -> DataFrame:
    """Landed order files, of the days asked for, as text columns, whatever their header order.

    A file that fails as a whole, such as a web page, fails the job.
    """
    if next(list_captures(root, name), None) is None:
        raise CaptureError(f"No order files found in {root}.")
    return read_order_lines_text(read_captures(spark, root, name, first, last))


def read_order_lines_text(files: DataFrame) -> DataFrame:
    """Order lines straight from capture bytes (``path, content``).

    A capture is read within its row, so a quoted line end does not split a
    record, and neither headers nor paths go through the driver.
    """
    return capture_lines(files, strict=True).select(*[field(name).alias(name) for name in BRONZE_COLUMNS])
