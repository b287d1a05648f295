"""Column sets, labels, messages and limits the results depend on."""

from __future__ import annotations

# Headers a daily order capture may carry (order does not matter).
LEGACY_ORDER_COLUMNS = (
    "order_id", "order_date", "store_id", "product_id", "quantity",
    "unit_price", "discount_pct", "sales_channel", "loyalty_member",
)
MIGRATED_ORDER_COLUMNS = (
    "order_id", "order_date", "store_id", "new_product_id", "quantity",
    "unit_price", "discount_pct", "sales_channel", "loyalty_member",
)
LEGACY_KEY = "product_id"
MIGRATED_KEY = "new_product_id"
MAX_CAPTURE_BYTES = 20 * 1024 * 1024

# Audit log fields, in file order.
AUDIT_FIELDS = (
    "timestamp_utc", "order_date", "status", "row_count", "file_size_bytes",
    "sha256", "error_message", "sort_date",
)

# Validation messages. Failure events are de-duplicated by their
# text, so the text must stay the same from run to run.
MSG_EMPTY = "Downloaded orders file is empty."
MSG_NOT_UTF8 = "Orders file is not valid UTF-8 CSV."
MSG_HTML = "Downloaded content is HTML, not CSV."
MSG_TOO_LARGE = "Downloaded orders file exceeds the 20 MiB limit."
MSG_NO_ROWS = "Orders CSV contains a header but no rows."
MSG_MANY_DATES = "Orders CSV must contain exactly one order_date."
MSG_MISSING_COLUMNS = "Missing columns: "
MSG_UNEXPECTED_COLUMNS = "Unexpected columns: "
MSG_EXTRA_FIELDS = "Row %d contains extra CSV fields."
MSG_NO_ORDER_ID = "Row %d has no order_id."
MSG_BAD_DATE = "Row %d has an invalid order_date: '%s'."
MSG_SIDECAR = "%s.sha256 does not match orders.csv."
MSG_KEPT_OTHER = "%s already has different contents; it was not overwritten."
MSG_KEPT_MISSING = "%s exists without orders.csv; inspect it manually."
MSG_FOLDER_DATE = "Folder %s contains orders for %s."
# Own wording: cases where a clear text is needed and no fixed one exists.
MSG_BOTH_KEYS = "Both product_id and new_product_id are present."
MSG_DUPLICATE_HEADER = "Header names are repeated."
HTML_PREFIXES = ("<!doctype html", "<html")

# Labels of the unknown product member.
UNKNOWN_PRODUCT = "Unknown Product (%s)"
UNKNOWN_LABELS = {
    "canonical_brand": "Unknown Brand",
    "canonical_category": "Unknown Category",
    "canonical_subcategory": "Unknown Subcategory",
}
PRODUCT_ATTRIBUTES = (
    "canonical_product_name", "canonical_brand",
    "canonical_category", "canonical_subcategory",
)

# Product matching weights, statuses and notes.
NAME_WEIGHT, BRAND_WEIGHT, PRICE_WEIGHT = 0.70, 0.20, 0.10
EXACT_MATCH = "exact_name_match"
NEEDS_REVIEW = "review_required"
NOTE_EXACT = "Normalized product names match."
NOTE_SUGGESTION = "Candidate is a suggestion; confirm it manually."
NOTE_REPEATED = "Multiple new products propose this legacy product; confirm manually."
NOTE_SUMMARY = "Every non-exact or repeated candidate requires human review."
REVIEW_DECISIONS = ("accepted", "corrected", "no_legacy_predecessor")

# Output layouts.
SILVER_COLUMNS = (
    "order_id", "order_date", "store_id", "product_id", "new_product_id",
    "canonical_product_id", "canonical_product_name", "canonical_brand",
    "canonical_category", "canonical_subcategory", "quantity", "unit_price",
    "discount_pct", "net_sales", "sales_channel", "loyalty_member",
)
GRAIN = ("order_date", "store_id", "canonical_product_id")
STORE_COLUMNS = (
    "store_id", "store_name", "city", "state", "region", "store_type",
    "latitude", "longitude",
)
WEATHER_MEASURES = (
    "temperature_2m_max_c", "temperature_2m_min_c", "precipitation_sum_mm",
)
WEATHER_COLUMNS = ("store_id", "date", *WEATHER_MEASURES, "source")
GOLD_COLUMNS = (
    "order_date", "store_id", "canonical_product_id", "canonical_product_name",
    "canonical_brand", "canonical_category", "canonical_subcategory",
    "store_name", "city", "state", "region", "store_type", "latitude",
    "longitude", "order_count", "units_sold", "net_sales",
    "temperature_2m_max_c", "temperature_2m_min_c", "precipitation_sum_mm",
    "source",
)
REPORT_GATES = (
    "duplicate_grain_rows", "missing_store_rows", "missing_weather_rows",
    "missing_product_name_rows", "missing_product_attribute_rows",
)
UNITS_TOLERANCE = 0.000001
SALES_TOLERANCE = 0.01

# Weather service request and response names.
WEATHER_URL = "https://archive-api.open-meteo.com/v1/archive"
WEATHER_SOURCE = "open-meteo"
DAILY_VARIABLES = ("temperature_2m_max", "temperature_2m_min", "precipitation_sum")

# Texts a default CSV reader of the pandas family takes as null.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
