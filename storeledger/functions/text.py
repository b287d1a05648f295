"""Text clean-up and name normalisation as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import NULL_TOKENS, UNKNOWN_PRODUCT

# Every character Python's str.strip takes as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Letters whose case-folded form is made of plain letters, while
# lower-casing leaves them alone.
FOLDED_LETTERS = {
    "ß": "ss", "ſ": "s", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi",
    "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "ŉ": " n", "ǰ": "j ", "ẖ": "h ",
    "ẗ": "t ", "ẘ": "w ", "ẙ": "y ", "ẚ": "a ",
}


def trim_ws(column: Column) -> Column:
    """Strip every kind of white space, not only blanks."""
    return F.btrim(column, F.lit(WHITE_SPACE))


def null_tokens(column: Column) -> Column:
    """Turn the texts a lenient CSV reader treats as missing into nulls."""
    return F.when(~column.isin(*NULL_TOKENS), column)


def parse_currency(column: Column) -> Column:
    """``$1,234.56`` -> ``1234.56`` as text; blanks become null."""
    return null_tokens(F.translate(trim_ws(column), "$,", ""))


def fold_case(column: Column) -> Column:
    lowered = F.lower(column)
    folded = lowered
    for letter, plain in FOLDED_LETTERS.items():
        folded = F.replace(folded, F.lit(letter), F.lit(plain))
    return F.when(lowered.rlike(f"[{''.join(FOLDED_LETTERS)}]"), folded).otherwise(lowered)


def normalize_name(column: Column) -> Column:
    """Lower-case words of letters and digits, one blank apart; null gives ''."""
    text = F.replace(fold_case(F.coalesce(column.cast("string"), F.lit(""))),
                     F.lit("&"), F.lit(" and "))
    return F.array_join(F.regexp_extract_all(text, F.lit("([a-z0-9]+)")), " ")


def squash(normalized: Column) -> Column:
    """A normalised name without blanks, the key of the exact-name match."""
    return F.replace(normalized, F.lit(" "), F.lit(""))


def unknown_label(product_id: Column) -> Column:
    return F.format_string(UNKNOWN_PRODUCT, product_id)
