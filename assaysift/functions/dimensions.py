"""Units as dimensions: a unit text is read as a product of powers and gives exponents and a factor.

The grammar: symbols with an optional whole exponent (``cm2``, ``g-1``, ``g^-1``, ``m²``), one after the
other or divided by ``/``, which inverts the symbol behind it. Everything is a column expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .units import unit_text

BASES = ("m", "kg", "s", "A", "K", "mol")

_LENGTH, _MASS, _TIME, _CURRENT, _HEAT, _AMOUNT = ([int(i == j) for j in range(6)] for i in range(6))
_CHARGE, _VOLT = [0, 0, 1, 1, 0, 0], [2, 1, -3, -1, 0, 0]
_WATT, _JOULE, _FARAD, _OHM = [2, 1, -3, 0, 0, 0], [2, 1, -2, 0, 0, 0], [-2, -1, 4, 2, 0, 0], [2, 1, -3, -2, 0, 0]
_NONE, _VOLUME = [0] * 6, [3, 0, 0, 0, 0, 0]
_PREFIXES = {"k": 1e3, "": 1.0, "m": 1e-3, "u": 1e-6, "µ": 1e-6, "n": 1e-9}

# Symbols as ``unit_text`` folds them, in lower case.
_PREFIXED = {
    "g": (_MASS, 1e-3), "a": (_CURRENT, 1.0), "ah": (_CHARGE, 3600.0), "v": (_VOLT, 1.0), "w": (_WATT, 1.0), "wh": (_JOULE, 3600.0), "j": (_JOULE, 1.0),
    "f": (_FARAD, 1.0), "s": (_TIME, 1.0), "mol": (_AMOUNT, 1.0), "l": (_VOLUME, 1e-3), "ohm": (_OHM, 1.0),
}
_PLAIN = {
    "m": (_LENGTH, 1.0), "km": (_LENGTH, 1e3), "cm": (_LENGTH, 1e-2), "mm": (_LENGTH, 1e-3), "um": (_LENGTH, 1e-6), "µm": (_LENGTH, 1e-6),
    "nm": (_LENGTH, 1e-9), "pm": (_LENGTH, 1e-12), "å": (_LENGTH, 1e-10), "angstrom": (_LENGTH, 1e-10), "angström": (_LENGTH, 1e-10), "min": (_TIME, 60.0),
    "h": (_TIME, 3600.0), "k": (_HEAT, 1.0), "kelvin": (_HEAT, 1.0), "°c": (_HEAT, 1.0), "c": (_CHARGE, 1.0), "%": (_NONE, 1e-2), "at%": (_NONE, 1e-2),
    "wt%": (_NONE, 1e-2), "cc": (_VOLUME, 1e-6),
}
SYMBOLS: dict[str, tuple[list[int], float]] = {p + s: (d, f * x) for s, (d, f) in _PREFIXED.items() for p, x in _PREFIXES.items()} | _PLAIN

_AMOUNTS = r"(?<![\p{L}^\-\d.%°/])[-+]?\d[\d.,]*(?:e[-+]?\d+)?(?:\s*[-±~]\s*\d[\d.,]*)*"
_FACTOR = r"(/?)\s*(°?\p{L}+%?|%)\s*\^?\(?([-+]?\d*)\)?\s*"


def unit_of(c: Column) -> Column:
    """The unit of a cell: its folded text without amounts; empty where there is none."""
    return degrees(bare_unit(c))


def bare_unit(c: Column) -> Column:
    """``unit_of`` before ``degrees``, for callers that store it in between."""
    bare = F.regexp_replace(unit_text(c), _AMOUNTS, " ")
    return F.regexp_replace(F.regexp_replace(bare, r"(?U)^[\s~≈<>±+]+|[\s.,;]+$", ""), r"(?U)\s+", " ")


def degrees(bare: Column) -> Column:
    """``c`` means degrees where it stands alone."""
    return F.when(bare == "c", F.lit("°c")).otherwise(bare)


def _symbols() -> Column:
    entries = [x for s, (d, f) in SYMBOLS.items() for x in (F.lit(s), F.array(*[F.lit(float(e)) for e in d], F.lit(math.log10(f))))]
    return F.create_map(*entries)


def parsed_unit(unit: Column) -> Column:
    """struct(dimension, factor) of a text from ``unit_of``; null where a part of it is no known unit.

    ``dimension`` has an exponent per base, as text such as ``2 -1 0 0 0 0``; ``factor`` is the size of
    one unit in base units, to twelve digits.
    """
    known, whole = _symbols(), F.regexp_replace(unit, _FACTOR, "") == ""
    factors = F.regexp_extract_all(unit, F.lit(_FACTOR), F.lit(0))

    def powers(part: Column) -> Column:
        digits = F.regexp_extract(part, _FACTOR, 3)
        power = F.when(digits == "", F.lit(1)).otherwise(digits.try_cast("int")) * F.when(F.regexp_extract(part, _FACTOR, 1) == "/", -1).otherwise(1)
        return F.transform(F.try_element_at(known, F.regexp_extract(part, _FACTOR, 2)), lambda e: e * power)

    zero = F.array(*[F.lit(0.0)] * 7)
    total = F.aggregate(F.transform(factors, powers), zero, lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
    dimension = F.array_join(F.transform(F.slice(total, 1, 6), lambda e: e.cast("int").cast("string")), " ")
    found = F.struct(dimension.alias("dimension"), F.pow(F.lit(10.0), F.element_at(total, 7)).alias("factor"))
    return F.when(whole & (F.size(factors) > 0) & total.isNotNull() & (F.size(F.filter(total, lambda e: e.isNull())) == 0), found)
