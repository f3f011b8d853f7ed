"""Text helpers shared by every operator.

Three null policies are kept apart on purpose, because each feeds a different
output:

* N1 ``or_empty``    - only a real null counts as empty (identifiers in corrections
  and duplicate flags),
* N2 ``is_missing``  - null or a missing-value word (range and missing checks),
* N3 ``norm_key``    - N2 plus case and whitespace folding (duplicate keys).
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character that counts as white space, ASCII and beyond. The Java class \s is
# ASCII only and SQL trim knows the plain blank only, so the set is spelled out.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
SPACE = "[" + WHITESPACE + "]"

# Words that mean "no value" (compared after strip and lower).
MISSING_WORDS = ("", "nan", "none", "null", "n/a", "na", "-")
# The same test as one pattern: a single scan instead of strip, lower and compare.
_MISSING = f"^{SPACE}*+(?:(?i:" + "|".join(w for w in MISSING_WORDS if w) + f"){SPACE}*+)?$"
# Text that strip and squeeze would change.
_UNTIDY = f"^{SPACE}|{SPACE}$|{SPACE}{{2}}|" + "[" + WHITESPACE.replace(" ", "", 1) + "]"


def _decimal_digits() -> tuple[str, str]:
    """Non-ASCII decimal digits and their ASCII counterparts."""
    digits = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
    return "".join(digits), "".join(str(unicodedata.decimal(c)) for c in digits)


_FOREIGN_DIGITS, _ASCII_DIGITS = _decimal_digits()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """Reference a column by its exact name, dots and blanks included."""
    return F.col(quoted(name))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def squeeze(c: Column) -> Column:
    """Collapse each run of white space to one blank."""
    return F.regexp_replace(c, SPACE + "+", " ")


def ascii_digits(c: Column) -> Column:
    return F.translate(c, _FOREIGN_DIGITS, _ASCII_DIGITS)


def or_empty(c: Column) -> Column:
    """Policy N1."""
    return F.coalesce(c.cast("string"), F.lit(""))


def is_floating(dtype: T.DataType | None) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def is_numeric(dtype: T.DataType | None) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def is_missing(c: Column, dtype: T.DataType | None = None) -> Column:
    """Policy N2. ``dtype`` is the column type; text is assumed when it is not given."""
    if is_floating(dtype):
        return c.isNull() | F.isnan(c)
    if is_numeric(dtype):
        return c.isNull()
    text = c.cast("string")
    return text.isNull() | text.rlike(_MISSING)


def text_or_blank(c: Column, dtype: T.DataType | None = None) -> Column:
    """The text as it stands, or an empty text where policy N2 sees no value."""
    return F.when(is_missing(c, dtype), F.lit("")).otherwise(c.cast("string"))


def norm_key(c: Column, dtype: T.DataType | None = None) -> Column:
    """Policy N3: comparison form of a cell, empty when there is nothing to compare."""
    if is_numeric(dtype):
        return F.when(is_missing(c, dtype), F.lit("")).otherwise(fmt6g(c.cast("double")))
    text = c.cast("string")
    lowered = F.lower(text)
    # Identifiers mostly hold no white space at all, which is the quickest thing to see.
    return (
        F.when(is_missing(c, dtype), F.lit(""))
        .when(text.rlike(SPACE) & text.rlike(_UNTIDY), squeeze(strip(lowered)))
        .otherwise(lowered)
    )


def safe_str(c: Column) -> Column:
    """Trimmed text, empty for a missing value (policy N2)."""
    return F.when(is_missing(c), F.lit("")).otherwise(strip(c.cast("string")))


def number_text(x: Column) -> Column:
    """A double as its shortest text, without exponent from 1e-4 to below 1e16; null stays null."""
    text, size = x.cast("string"), F.abs(x)
    plain = F.rtrim(text.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    exponent = F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), r"E(?=\d)", "e+")
    exponent = F.regexp_replace(F.regexp_replace(exponent, "E-", "e-"), r"e([+-])(\d)$", "e$10$2")
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(size == float("inf"), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(exponent)
    )


def fmt6g(x: Column) -> Column:
    """``%.6g``: six significant digits, no trailing zeros, rounded as C does.

    ``format_string('%g')`` rounds the decimal text half up and keeps zeros. The
    scientific pattern of ``format_number`` looks at the exact binary value instead.
    Whole numbers and numbers with up to three decimals, the common case, skip it.
    """
    size = F.abs(x)
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(x), F.lit("nan"))
        .when(size == 0, F.when(x.cast("string").startswith("-"), F.lit("-0")).otherwise(F.lit("0")))
        .when((size < 1e6) & (F.rint(x) == x), x.cast("bigint").cast("string"))
        .when((size >= 1e-3) & (size < 1e3) & (F.rint(x * 1e3) / 1e3 == x), x.cast("string"))
        .when((size >= 9.999995e-5) & (size < 999999.5), _drop_zeros(_scientific(x).cast("decimal(18,9)").cast("string")))
        .when(size == float("inf"), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .otherwise(_exponent_text(_scientific(_half_to_even(x))))
    )


def _scientific(x: Column) -> Column:
    return F.call_function("format_number", x, F.lit("0.#####E0"))


def _drop_zeros(c: Column) -> Column:
    return F.rtrim(F.rtrim(c, F.lit("0")), F.lit("."))


def _exponent_text(sci: Column) -> Column:
    """``1.5E7`` to ``1.5e+07``."""
    signed = F.regexp_replace(F.regexp_replace(sci, "E(?!-)", "e+"), "E-", "e-")
    return F.regexp_replace(signed, r"e([+-])(\d)$", "e$10$2")


def _half_to_even(x: Column) -> Column:
    """Move a whole number that ends in an exact half of the sixth digit to the even side.

    The formatter sends these up. Smaller magnitudes need no help.
    """
    size = F.abs(x)
    whole = size.cast("bigint")
    unit = F.rpad(F.lit("1"), F.length(whole.cast("string")) - 5, "0").cast("bigint")
    left = whole % unit
    tie = (whole.cast("double") == size) & (left * 2 == unit) & (F.call_function("mod", (whole - left) / unit, F.lit(2)) == 0)
    in_range = (size >= 1e6) & (size < 9e18)
    return F.when(in_range, F.when(tie, F.signum(x) * (whole - left).cast("double")).otherwise(x)).otherwise(x)
