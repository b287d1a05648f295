"""Validation of landed capture files, all of them in one pass.

Each file is one row of ``path, content`` and is at most 20 MiB, so it is judged
within its row: every rule is a column expression, and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import trim_ws
from ..sources.captures import folder_date, verify_checksums


def decoded(content: Column) -> Column:
    """UTF-8 text without a byte order mark; null when the bytes are not UTF-8."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), F.regexp_replace(text, "^﻿", ""))


def is_html(text: Column) -> Column:
    """Whether a text, white space aside, starts like a web page in any case."""
    prefixes = "|".join(K.HTML_PREFIXES)
    return text.rlike(rf"\A[\p{{IsWhite_Space}}\x1C-\x1F]*(?i:{prefixes})")


def csv_pieces(line: Column) -> Column:
    """Fields of one CSV record as written, quotes included."""
    # A leading comma makes every field, empty ones too, follow a comma.
    quoted = F.regexp_extract_all(
        F.concat(F.lit(","), line),
        F.lit(r',("[^"]*+(?:""[^"]*+)*+(?:"|\z)[^,]*+|[^,]*+)'), F.lit(1))
    return F.when(F.instr(line, '"') == 0, F.split(line, ",")).otherwise(quoted)


def unquote(piece: Column) -> Column:
    """The value of a field: outer quotes dropped, doubled quotes undone."""
    inner = F.regexp_replace(piece, r'^"([^"]*+(?:""[^"]*+)*+)(?:"|\z)', "$1")
    return F.when(
        F.startswith(piece, F.lit('"')), F.replace(inner, F.lit('""'), F.lit('"'))
    ).otherwise(piece)


def csv_fields(line: Column) -> Column:
    """Values of one CSV record."""
    pieces = csv_pieces(line)
    return F.when(F.instr(line, '"') == 0, pieces).otherwise(F.transform(pieces, unquote))


def header_line(text: Column) -> Column:
    return F.substring_index(F.substring_index(text, "\n", 1), "\r", 1)


def schema_variant(columns: Column) -> Column:
    """Name of the product key when the header set is allowed, else null."""
    # Both sets differ in the key alone: all other names, and as many different names as a set has.
    whole = F.size(F.array_distinct(columns)) == len(K.LEGACY_ORDER_COLUMNS)
    for name in sorted(set(K.LEGACY_ORDER_COLUMNS) & set(K.MIGRATED_ORDER_COLUMNS)):
        whole = F.array_contains(columns, name) & whole
    return F.when(whole, F.when(F.array_contains(columns, K.LEGACY_KEY), K.LEGACY_KEY).when(
        F.array_contains(columns, K.MIGRATED_KEY), K.MIGRATED_KEY))


def schema_message(columns: Column) -> Column:
    """What is missing and unexpected against the union of both header sets."""
    names = sorted(set(K.LEGACY_ORDER_COLUMNS) | set(K.MIGRATED_ORDER_COLUMNS))
    # Filters are called, not generated: set functions, spelled out in the code of each
    # branch, made methods too large for the JVM to compile.
    missing = F.filter(F.array(*[F.lit(c) for c in names]), lambda c: ~F.array_contains(columns, c))
    extra = F.filter(F.sort_array(F.array_distinct(columns)), lambda c: ~c.isin(*names))

    message = F.concat_ws(
        "; ",
        F.when(F.size(missing) > 0, F.concat(F.lit(K.MSG_MISSING_COLUMNS), F.array_join(missing, ", "))),
        F.when(F.size(extra) > 0, F.concat(F.lit(K.MSG_UNEXPECTED_COLUMNS), F.array_join(extra, ", "))),
    )
    return F.when(message == "", K.MSG_BOTH_KEYS).otherwise(message)


def records(text: Column) -> Column:
    """Non-blank CSV records of a text. Line ends inside quoted fields do not split."""
    plain = F.filter(F.split(text, r"\r\n|\r|\n"), lambda r: r != "")
    # Only a quote at the start of a field opens a quoted field.
    quoted = F.regexp_extract_all(
        text,
        F.lit(r'((?:[^"\r\n]++|(?<![^,\r\n])"[^"]*+(?:""[^"]*+)*+(?:"|\z)|")++)'), F.lit(1))
    return F.when(F.instr(text, '"') > 0, quoted).otherwise(plain)


def iso_date(text: Column) -> Column:
    """The text itself when it is a real ``yyyy-MM-dd`` date, else null."""
    return F.when(
        text.rlike(r"\A\d{4}-\d{2}-\d{2}\z") & text.try_cast("date").isNotNull(), text
    )


def _inspected(files: DataFrame, most_bytes: int | None) -> DataFrame:
    """One row per file with its facts and the first whole-file failure.

    A source that knows sizes beforehand hands in ``length`` and leaves out the content of large files.
    """
    size = F.length("content").cast("bigint")
    staged = files.select(
        "path",
        (F.coalesce(size, F.col("length")) if "length" in files.columns else size).alias("file_size_bytes"),
        F.sha2("content", 256).alias("sha256"),
        decoded(F.col("content")).alias("text"),
    )
    staged = staged.withColumn("header", header_line(F.col("text")))
    staged = staged.withColumn(
        "columns",
        F.when(F.col("header") == "", F.array().cast("array<string>")).otherwise(csv_fields(F.col("header")))).drop("header")
    variant = schema_variant(F.col("columns"))
    return staged.withColumn("product_id_column", variant).withColumn(
        "file_error",
        F.when(F.lit(False) if most_bytes is None else F.col("file_size_bytes") > most_bytes, K.MSG_TOO_LARGE)
        .when(F.col("file_size_bytes") == 0, K.MSG_EMPTY)
        .when(F.col("text").isNull(), K.MSG_NOT_UTF8)
        .when(is_html(F.col("text")), K.MSG_HTML)
        .when(F.col("product_id_column").isNull(), schema_message(F.col("columns")))
        .when(F.size("columns") > len(K.LEGACY_ORDER_COLUMNS), K.MSG_DUPLICATE_HEADER),
    )


def _parsed(files: DataFrame, most_bytes: int | None) -> DataFrame:
    """Files with the pieces of every data record; null for files that failed as a whole."""
    body = F.filter(records(F.col("text")), lambda _, at: at > 0)
    return _inspected(files, most_bytes).withColumn(
        "rows", F.when(F.col("file_error").isNull(), F.transform(body, csv_pieces))
    ).drop("text")


def capture_lines(files: DataFrame, strict: bool = False) -> DataFrame:
    """Data records of readable files, numbered from 2, with the values of their fields.

    ``strict`` fails the job on a file that cannot be read as a whole.
    """
    rows = F.col("rows")
    if strict:
        rows = F.when(
            F.col("file_error").isNotNull(), F.raise_error(F.concat_ws(": ", "path", "file_error"))).otherwise(rows)
    values = F.transform(rows, lambda pieces: F.transform(pieces, unquote))
    return _parsed(files, None).select(
        "path", "columns", F.posexplode(values).alias("at", "values")
    ).select("path", "columns", "values", (F.col("at") + 2).alias("row_no"))


def place(name: str) -> Column:
    """Index of a named column in the header; null when the header lacks it."""
    return F.nullif(F.array_position("columns", F.lit(name)), F.lit(0)).cast("int") - 1


def field(name: str) -> Column:
    """Value of a named field of a record from ``capture_lines``; null when the row is short."""
    return F.get("values", place(name))


def check_captures(files: DataFrame, most_bytes: int | None = None) -> DataFrame:
    """Facts and the first failure of every file; ``error_message`` is null when valid.

    Only new deliveries have a limit, ``most_bytes``; a capture that is kept stays valid
    whatever its size. A file is one row, so its records are checked where they
    are: no explode, no shuffle, however many files there are.
    """
    keys = _parsed(files, most_bytes).withColumns({"id_at": place("order_id"), "date_at": place("order_date")})

    def key_of(pieces, at):
        return trim_ws(F.coalesce(unquote(F.get(pieces, F.col(at))), F.lit("")))

    read = keys.withColumn("read", F.transform("rows", lambda p: F.struct(
        F.size(p).alias("width"), key_of(p, "id_at").alias("order_id"),
        key_of(p, "date_at").alias("order_date"))))

    def row_error(r, at):
        row_no = at + 2
        return (
            F.when(r["width"] > F.size("columns"), F.format_string(K.MSG_EXTRA_FIELDS, row_no))
            .when(r["order_id"] == "", F.format_string(K.MSG_NO_ORDER_ID, row_no))
            .when(iso_date(r["order_date"]).isNull(),
                  F.format_string(K.MSG_BAD_DATE, row_no, r["order_date"]))
        )

    dates = F.transform("read", lambda r: r["order_date"])
    judged = read.select(
        "path", "sha256", "file_size_bytes", "product_id_column", "file_error",
        F.coalesce(F.size("rows"), F.lit(0)).cast("bigint").alias("row_count"),
        F.array_min(dates).alias("order_date"), F.array_max(dates).alias("last_date"),
        F.get(F.filter(F.transform("read", row_error), lambda e: e.isNotNull()), F.lit(0)).alias("row_error"),
    )
    error = F.coalesce(
        "file_error",
        F.when(F.col("row_count") == 0, K.MSG_NO_ROWS),
        "row_error",
        F.when(F.col("order_date") != F.col("last_date"), K.MSG_MANY_DATES),
    )
    # Passing the result through a generator keeps a later filter on it from
    # being pushed down, where it would repeat the parsing many times over.
    return judged.select("path", F.inline_outer(F.array(F.struct(
        "sha256", "file_size_bytes", "row_count", "order_date", "product_id_column",
        error.alias("error_message")))))


def check_sidecars(checked: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Also reject valid files whose sidecar holds another hash; a file may have none."""
    wrong = F.format_string(K.MSG_SIDECAR, "path")
    return verify_checksums(checked, sidecars).withColumn(
        "error_message", F.coalesce("error_message", F.when(F.col("checksum_state") == "mismatch", wrong)),
    ).select(*checked.columns)


def check_folder(checked: DataFrame) -> DataFrame:
    """Also reject valid files that lie in the folder of another date."""
    folder = folder_date(F.col("path"))
    return checked.withColumn(
        "error_message",
        F.coalesce(
            "error_message",
            F.when(folder != F.col("order_date"),
                   F.format_string(K.MSG_FOLDER_DATE, folder, "order_date")),
        ),
    )


def split_captures(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(facts of valid files, path and message of rejected files)."""
    facts = checked.where("error_message is null").select(
        "path", "order_date", "row_count", "sha256", "file_size_bytes", "product_id_column")
    rejects = checked.where("error_message is not null").select("path", "error_message")
    return facts, rejects


def validate_captures(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_captures(check_captures(files))
