"""Number parsing and unit conversion as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import WHITESPACE, ascii_digits, is_floating, is_numeric

# The canonical fields that hold numbers.
NUMERIC_FIELDS = (
    "carbonization_temperature_C",
    "BET_m2_g",
    "d002_nm",
    "ID_IG",
    "XPS_N_at_pct",
    "XPS_O_at_pct",
    "pore_volume_cm3_g",
    "micropore_volume_cm3_g",
    "mass_loading_mg_cm2",
    "electrode_thickness_um",
    "compacted_density_g_cm3",
    "ICE_pct",
    "capacity_mAh_g",
    "capacitance_F_g",
    "current_density_A_g",
)

# Correction kinds and confidence levels.
UNIT_CONVERSION = "unit_conversion"
POSSIBLE_UNIT = "possible_unit_conversion"
POSSIBLE_PERCENT = "possible_percent_scale"
HIGH = "high"
MEDIUM = "medium"

# \p{Nd} and the spelled-out white space make the patterns see every script, not ASCII only.
_NUMBER = r"[-+]?\p{Nd}*\.?\p{Nd}+(?:[eE][-+]?\p{Nd}+)?"

# Units are compared on a folded text (see ``unit_text``). Instead of folding every cell,
# the patterns accept each spelling that folds to the wanted character.
_GAP = "[" + WHITESPACE + "·]"
_AMOUNT = rf"(?:^|{_GAP})[\p{{Nd}}²³]*\.?[\p{{Nd}}²³]+"
_SPELLINGS = {"2": "[2²]", "3": "[3³]", "-": "[-−⁻]", "k": "[kK\u212a]", "å": "[åÅ\u212b]", "^": r"\^", "/": "/"}


def _letters(word: str) -> list[str]:
    return [_SPELLINGS.get(ch, f"[{ch}{ch.upper()}]") for ch in word]


def _word(*words: str) -> str:
    """Pattern for any of the words, in every spelling."""
    return "(?:" + "|".join("".join(_letters(w)) for w in words) + ")"


def _spaced(*words: str) -> str:
    """The same with white space allowed between any two characters."""
    return "(?:" + "|".join(f"{_GAP}*".join(_letters(w)) for w in words) + ")"


_KELVIN = rf"{_AMOUNT}{_GAP}*{_word('k')}(?:{_GAP}|$)|[ ·]{_word('kelvin')}"
_ANGSTROM_WORD = _word("å", "angstrom", "angström")
_ANGSTROM = rf"{_ANGSTROM_WORD}|{_AMOUNT}{_GAP}*{_word('a')}(?:{_GAP}|$)"
_NM_OR_ANGSTROM = rf"{_word('nm')}|{_ANGSTROM_WORD}"
_AMPERE_HOUR = rf"(?<![mM]){_word('ah')}{_GAP}*/?{_GAP}*{_word('g')}"
_CM2_PER_G = _spaced("cm2/g", "cm^2/g", "cm2g")
_MA_PER_G = _spaced("ma/g", "mag")
_G_PER_M2 = _spaced("g/m2", "gm-2", "gm2")

# Spellings folded before units are compared: minus signs, superscripts, middle dot, micro.
_SIGNS = ("−⁻²³·μ", "--23 µ")


def parse_number(c: Column, dtype: T.DataType | None = None) -> Column:
    """First number in a text, or null. Commas are dropped; the first match wins.

    Numeric columns pass through, with NaN turned into null: a NaN that stays would
    compare as larger than every bound.
    """
    if is_floating(dtype):
        return F.when(~F.isnan(c), c.cast("double"))
    if is_numeric(dtype):
        return c.cast("double")
    return _once(first_number(c), number_of)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def first_number(c: Column) -> Column:
    """Text of the first number, or empty. Commas are dropped before the search."""
    return F.regexp_extract(F.replace(c, F.lit(","), F.lit("")), _NUMBER, 0)


def number_of(found: Column) -> Column:
    """Number of a text from ``first_number``; digits of other scripts are turned into ASCII first."""
    ascii_only = F.length(found) == F.octet_length(found)
    return F.when(found != "", F.when(ascii_only, found).otherwise(ascii_digits(found)).try_cast("double"))


def unit_text(c: Column) -> Column:
    """Lower-case text with one spelling per sign; empty for null."""
    return F.coalesce(F.translate(F.lower(c.cast("string")), *_SIGNS), F.lit(""))


@dataclass(frozen=True)
class Conversion:
    """One automatic correction: where it applies, when, and what it computes."""

    code: str
    fields: tuple[str, ...]
    kind: str
    confidence: str
    reason: str
    applies: Callable[[Column, Column], Column]  # (source text, number) -> boolean
    convert: Callable[[Column], Column]


# Rules of one field are tried in this order; the first that applies wins.
CONVERSIONS = (
    Conversion(
        "kelvin", ("carbonization_temperature_C",), UNIT_CONVERSION, HIGH, "temperature given in K, stored in °C",
        lambda t, num: t.rlike(_KELVIN),
        lambda num: num - 273.15,
    ),
    Conversion(
        "angstrom", ("d002_nm",), UNIT_CONVERSION, HIGH, "spacing given in Å, stored in nm",
        lambda t, num: t.rlike(_ANGSTROM),
        lambda num: num / 10.0,
    ),
    Conversion(
        "bare_angstrom", ("d002_nm",), POSSIBLE_UNIT, MEDIUM, "no unit, but the size suggests Å; stored in nm",
        lambda t, num: num.between(2.5, 5.0) & ~t.rlike(_NM_OR_ANGSTROM),
        lambda num: num / 10.0,
    ),
    Conversion(
        "cm2_per_g", ("BET_m2_g",), UNIT_CONVERSION, HIGH, "surface area given in cm2/g, stored in m2/g",
        lambda t, num: t.rlike(_CM2_PER_G),
        lambda num: num / 10000.0,
    ),
    Conversion(
        "ma_per_g", ("current_density_A_g",), UNIT_CONVERSION, HIGH, "current density given in mA/g, stored in A/g",
        lambda t, num: t.rlike(_MA_PER_G),
        lambda num: num / 1000.0,
    ),
    Conversion(
        "ah_per_g", ("capacity_mAh_g",), UNIT_CONVERSION, HIGH, "capacity given in Ah/g, stored in mAh/g",
        lambda t, num: t.rlike(_AMPERE_HOUR),
        lambda num: num * 1000.0,
    ),
    Conversion(
        "g_per_m2", ("mass_loading_mg_cm2",), UNIT_CONVERSION, HIGH, "loading given in g/m2, stored in mg/cm2",
        lambda t, num: t.rlike(_G_PER_M2),
        lambda num: num * 0.1,
    ),
    Conversion(
        "percent_scale", ("XPS_N_at_pct", "XPS_O_at_pct", "ICE_pct"), POSSIBLE_PERCENT, MEDIUM,
        "value between 0 and 1 next to a percent sign, scaled to percent",
        lambda t, num: (num > 0) & (num <= 1) & t.contains("%"),
        lambda num: num * 100.0,
    ),
)


def conversions_for(field: str) -> list[Conversion]:
    return [rule for rule in CONVERSIONS if field in rule.fields]


def conversion_code(field: str, text: Column, num: Column) -> Column:
    """Code of the rule that applies to a cell, or null."""
    code = None
    for rule in conversions_for(field):
        hit = num.isNotNull() & rule.applies(text, num)
        code = F.when(hit, F.lit(rule.code)) if code is None else code.when(hit, F.lit(rule.code))
    return F.lit(None).cast("string") if code is None else code


def converted(field: str, num: Column, code: Column) -> Column:
    """The number after the rule named by ``code``; unchanged when there is none."""
    out = None
    for rule in conversions_for(field):
        hit = code == rule.code
        out = F.when(hit, rule.convert(num)) if out is None else out.when(hit, rule.convert(num))
    return num if out is None else out.otherwise(num)


def normalize_value(field: str, c: Column, dtype: T.DataType | None = None) -> Column:
    """``struct(value, code)`` for a single cell, for use in ad-hoc selects."""
    text = c.cast("string")
    coded = _once(parse_number(c, dtype), lambda num: F.struct(num.alias("num"), conversion_code(field, text, num).alias("code")))
    return _once(coded, lambda x: F.struct(converted(field, x["num"], x["code"]).alias("value"), x["code"].alias("code")))
