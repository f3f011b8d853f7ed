"""Header spelling as column expressions: normal form, unit suffixes, candidate spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# One-word unit suffixes that may trail a header. A header is compared word
# by word, so units spelled with a blank ("m2 g-1") cannot match and are not listed.
UNIT_WORDS = (
    "m2/g", "cm2/g", "cm3/g", "mg/cm2", "g/cm3", "mah/g", "f/g", "a/g", "ma/g",
    "nm", "a", "angstrom", "um", "at%", "wt%", "%", "c", "v", "mv/s",
)

# Words that start a trailing remark.
REMARK_WORDS = ("unit", "units", "value", "reported", "from", "source")

_UNIT_SUFFIX = "(?:(?:^| )(?:" + "|".join(UNIT_WORDS) + "))+$"
_REMARK = " +(?:" + "|".join(REMARK_WORDS) + ") .*$"


def header_text(c: Column) -> Column:
    """Lower-case header with folded signs, other characters blanked, blanks collapsed."""
    folded = F.translate(F.lower(strip(c)), "²³⁻−·_", "23--  ")
    return F.btrim(F.regexp_replace(folded, "[^a-z0-9%/+-]+", " "), F.lit(" "))


def strip_unit_words(c: Column) -> Column:
    return F.regexp_replace(c, _UNIT_SUFFIX, "")


def strip_remark(c: Column) -> Column:
    return F.regexp_replace(c, _REMARK, "")


def without_brackets(c: Column) -> Column:
    return F.regexp_replace(c, r"\([^)]*\)", " ")


def alias_text(c: Column) -> Column:
    return strip_unit_words(header_text(c))


def candidate_spellings(c: Column) -> list[Column]:
    """Five spellings of one header, by position; some may be equal or empty."""
    full, bare = header_text(c), header_text(without_brackets(c))
    return [full, bare, *shortened(full, bare)]


def shortened(full: Column, bare: Column) -> list[Column]:
    """The last three spellings, from the first two."""
    return [strip_unit_words(full), strip_unit_words(bare), strip_remark(full)]


def distinct_spellings(spellings: list[Column]) -> Column:
    return F.array_distinct(F.array_remove(F.array(*spellings), ""))


def header_candidates(c: Column) -> Column:
    """The distinct non-empty spellings of one header, in order."""
    return distinct_spellings(candidate_spellings(c))
