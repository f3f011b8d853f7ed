"""Duplicate detection on exact normalised keys.

Three detectors share one pass: every row emits at most three keys, keys are counted with
map-side combining, and rows whose key repeats are reported. A window over the key would
pull a hot key into one task; counting first does not, and the way back to the rows is
chosen by the measured size of the repeated keys:

* small enough: they are broadcast and the rows are not shuffled at all,
* otherwise: a shuffle semi join in which hot keys are split by salt. Where rows carry a place (``AT``), only
  places are joined; those that repeat come back to the rows as broadcast bitmaps, a bit a row.

Keys are counted and joined by two 64-bit hashes, so their texts are not shuffled for that; a text
travels only with a row of which it is asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import column, fmt6g, is_numeric, norm_key, or_empty
from ..schema import P1, P2, ROW_KEY, SEQ_DUPLICATE
from ..sources.scratch import materialise
from .validate import flag_columns

SAMPLE, PAPER_NAME, NEAR = 1, 2, 3
ALL = (SAMPLE, PAPER_NAME, NEAR)
IDS = ("paper_id", "sample_id", "sample_name")

# Columns compared for near-duplicates, and how many must be filled.
NEAR_COLUMNS = (
    "paper_id", "BET_m2_g", "d002_nm", "ID_IG", "ICE_pct", "capacity_mAh_g", "capacitance_F_g", "current_density_A_g",
)
NEAR_MINIMUM = 4

# (detector, field, risk, code, reason, action)
DETECTORS = (
    (SAMPLE, "sample_id", P1, "dup_sample_id", "other rows carry this sample_id",
     "merge the rows, or give each measurement an id of its own"),
    (PAPER_NAME, "paper_id+sample_name", P1, "dup_paper_sample", "the paper has further rows of this sample_name",
     "tell apart by conditions what was measured twice; merge the rest"),
    (NEAR, "near_duplicate_values", P2, "near_duplicate", "another row agrees in every compared value",
     "keep one row unless both places report a measurement"),
)

#: Hashes of a comparison key. Keys that agree in both are taken for equal: of 10**9 keys, two differing ones do with a chance below 10**-20.
HASHES = ("_hash", "_hash2")

# Repeated keys are broadcast up to this many bytes; beyond it the rows of the detectors with most are shuffled.
BROADCAST_BYTES = 32 << 20
BROADCAST_ROW = 32  # bytes of a detector and its hashes
#: Column of ``placed``: a number of each row, without large gaps.
AT = "_at"
# Bitmaps of the places that repeat are broadcast up to this many bytes; beyond it rows are shuffled.
BITMAP_BYTES = 64 << 20
BITMAP_ROW = 4096 + 64  # bytes of a bitmap of 32,768 places
# A hot key holds more than this share of all repeated rows, so there are fewer hot keys
# than the inverse, whatever the size of the data.
HOT_SHARE = 1 / 10_000


def compared_columns(names: Sequence[str], detectors: Sequence[int] = ALL) -> list[str]:
    """The columns of a table that the detectors read, in table order."""
    wanted = {"paper_id", "sample_id"}
    if PAPER_NAME in detectors:
        wanted.add("sample_name")
    if NEAR in detectors:
        wanted.update(NEAR_COLUMNS)
    return [c for c in names if c in wanted]


def placed(df: DataFrame) -> DataFrame:
    """``df`` with a place for each row, which must be stored before it is used."""
    return df.withColumn(AT, F.monotonically_increasing_id())


def duplicate_keys(
    df: DataFrame, keys: Sequence[str] = ROW_KEY, detectors: Sequence[int] = ALL, numeric_ids: bool = False
) -> DataFrame:
    """One row per (table row, detector) with a non-empty comparison key.

    Identifiers are compared as text, also those of a numeric column; ``numeric_ids`` compares
    the latter by six significant digits, like measured values.

    Blank keys are dropped here, before any shuffle, so blanks never meet in one task.
    The numbers go through one lambda over an array: the same text function for each
    column would make the generated code of the stage too long to be compiled well.
    A place (``AT``) stays with its row.
    """
    keys = [*keys, *([AT] if AT in df.columns else [])]
    types = {f.name: f.dataType for f in df.schema.fields}
    if not numeric_ids:
        df = df.withColumns({c: column(c).cast("string") for c in IDS if c in types and is_numeric(types[c])})
        types |= {c: T.StringType() for c in IDS if c in types}
    compared = [c for c in NEAR_COLUMNS if c in types]
    near = NEAR in detectors and len(compared) >= NEAR_MINIMUM
    by_name = PAPER_NAME in detectors and "paper_id" in types and "sample_name" in types
    needed = [c for c, of in zip(IDS, (by_name, SAMPLE in detectors, by_name)) if of]
    texts = [c for c in needed if c in types]
    texts += [c for c in compared if near and c not in texts and not is_numeric(types[c])]
    numbers = [c for c in compared if near and is_numeric(types[c])]

    raw = [or_empty(column(c)) if c in types else F.lit("") for c in ("paper_id", "sample_id", "sample_name")]
    number_texts = F.transform(F.array(*[column(c).cast("double") for c in numbers]), fmt6g) if numbers else F.array()
    base = df.select(
        *[column(k) for k in keys],
        *[c.alias(n) for c, n in zip(raw, ("_paper", "_sample", "_name"))],
        *[norm_key(column(c), types[c]).alias(f"_t_{c}") for c in texts],
        number_texts.alias("_numbers"),
    )

    def normal(c: str) -> Column:
        """Comparison text, null where there is nothing to compare."""
        if c in texts:
            return F.when(F.col(f"_t_{c}") != "", F.col(f"_t_{c}"))
        text = F.get("_numbers", F.lit(numbers.index(c)))
        return F.when(text != "nan", text)

    def entry(detector: int, key: Column, key2: Column, name: Column) -> Column:
        return F.struct(F.lit(detector).alias("detector"), key.alias("key"), key2.alias("key2"), name.alias("name"))

    nothing = F.lit("")
    found = []
    if "sample_id" in texts:
        sample = F.col("_t_sample_id")
        found.append(F.when(sample != "", entry(SAMPLE, sample, nothing, nothing)))
    if by_name:
        paper, name = F.col("_t_paper_id"), F.col("_t_sample_name")
        found.append(F.when((paper != "") & (name != ""), entry(PAPER_NAME, paper, name, F.col("_name"))))
    if near:
        # Joined without an array of them: an array function would interpret all of its parts.
        filled = reduce(add, [normal(c).isNotNull().cast("int") for c in compared])
        marker = F.concat_ws("||", *[F.concat(F.lit(f"{c}="), normal(c)) for c in compared])
        found.append(F.when(filled >= NEAR_MINIMUM, entry(NEAR, marker, nothing, nothing)))
    if not found:
        found = [F.lit(None).cast("struct<detector:int,key:string,key2:string,name:string>")]
    return (
        base.select(*[column(k) for k in keys], "_paper", "_sample", F.array(*found).alias("_found"))
        .select(*[column(k) for k in keys], "_paper", "_sample", F.explode_outer("_found").alias("d"))
        .where("d IS NOT NULL")
        .select(*[column(k) for k in keys], "_paper", "_sample", "d.*")
    )


def _hashed(keyed: DataFrame) -> DataFrame:
    """With 128 bits that stand for the key, so that key texts are neither shuffled to be counted nor compared."""
    return keyed.withColumns({HASHES[0]: F.xxhash64("key", "key2"), HASHES[1]: F.xxhash64(F.lit("second"), "key2", "key")})


def repeated_keys(keyed: DataFrame) -> DataFrame:
    """(detector, hashes, n) of the keys that occur more than once, with their number of rows."""
    return _hashed(keyed).groupBy("detector", *HASHES).agg(F.count("*").alias("n")).where("n > 1")


def rows_with_repeated_key(
    keyed: DataFrame, keys: Sequence[str] = ROW_KEY, broadcast_bytes: int = BROADCAST_BYTES, hot_share: float = HOT_SHARE,
    of: Callable[[list[int]], DataFrame] | None = None, bitmap_bytes: int = BITMAP_BYTES,
) -> DataFrame:
    """Keep the rows whose key repeats. Writes hashes of the repeated keys to the shared folder first.

    Detectors with few repeated keys have them broadcast; rows of the others, or only their places, are shuffled. ``of`` gives the rows
    of some detectors only, where that is less work than all of ``keyed``.
    """
    repeated = materialise(repeated_keys(keyed), "repeated")
    sizes = repeated.groupBy("detector").agg(F.count("*").alias("keys"), F.sum("n").alias("rows")).orderBy("keys").collect()
    few, many, left = [], [], broadcast_bytes
    for r in sizes:  # at most a row per detector
        left -= r["keys"] * BROADCAST_ROW
        (few if left >= 0 else many).append(r["detector"])
    by = ["detector", *HASHES]

    def found(detectors: list[int]) -> DataFrame:
        return of(detectors) if of else keyed.where(F.col("detector").isin(detectors)) if few and many else keyed

    def rows(detectors: list[int]) -> DataFrame:
        return _hashed(found(detectors))

    parts = []
    if few or not many:
        targets = F.broadcast(repeated.where(F.col("detector").isin(few)).select(*by))
        parts.append(rows(few or list(ALL)).join(targets, by, "left_semi"))
    if many:
        limit, targets = max(1, int(sum(r["rows"] for r in sizes) * hot_share)), repeated.where(F.col("detector").isin(many))
        if AT in keyed.columns:
            places = _salted_semi_join(rows(many).select(*by, AT), targets, (AT,), limit)
            parts.append(_rows_at(found(many), places, bitmap_bytes))
        else:
            parts.append(_salted_semi_join(rows(many), targets, keys, limit))
    parts = [p.select(*[column(c) for c in keyed.columns]) for p in parts]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _salted_semi_join(rows: DataFrame, repeated: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Semi join by shuffle; keys of more than ``limit`` rows are split."""
    by = ["detector", *HASHES]
    hot = F.broadcast(repeated.where(F.col("n") > limit).select(*by, F.ceil(F.col("n") / limit).cast("int").alias("_splits")))
    splits = F.coalesce("_splits", F.lit(1))
    salted = rows.join(hot, by, "left").withColumn("_salt", F.pmod(F.xxhash64(*[column(k) for k in keys]), splits).cast("int"))
    targets = repeated.join(hot, by, "left").select(*by, F.explode(F.sequence(F.lit(0), splits - 1)).alias("_salt"))
    return salted.join(targets, [*by, "_salt"], "left_semi")


def _rows_at(rows: DataFrame, places: DataFrame, bitmap_bytes: int) -> DataFrame:
    """The rows whose (detector, place) is among ``places``. Writes a bitmap per detector and 32,768 places to the shared folder."""
    number, bit = F.bitmap_bucket_number(F.col(AT)), F.bitmap_bit_position(F.col(AT))
    maps = places.groupBy("detector", number.alias("_number")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    maps = materialise(maps, "places")
    small = maps.count() * BITMAP_ROW <= bitmap_bytes
    joined = rows.withColumn("_number", number).join(F.broadcast(maps) if small else maps, ["detector", "_number"])
    octet = F.conv(F.hex(F.substring(F.col("_bits"), F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return joined.withColumns({"_octet": octet, "_bit": (bit % 8).cast("int")}).where("getbit(_octet, _bit) = 1")


def duplicate_flags(
    df: DataFrame, keys: Sequence[str] = ROW_KEY, broadcast_bytes: int = BROADCAST_BYTES, hot_share: float = HOT_SHARE
) -> DataFrame:
    """Flags of all three detectors over a cleaned table; a row can be reported by each of them."""
    hits = rows_with_repeated_key(duplicate_keys(df, keys), keys, broadcast_bytes, hot_share, lambda some: duplicate_keys(df, keys, some))

    def per_detector(at: int) -> Column:
        out = None
        for d in DETECTORS:
            hit = F.col("detector") == d[0]
            out = F.when(hit, F.lit(d[at])) if out is None else out.when(hit, F.lit(d[at]))
        return out

    value = (
        F.when(F.col("detector") == SAMPLE, F.col("_sample"))
        .when(F.col("detector") == PAPER_NAME, F.concat_ws(" | ", "_paper", "name"))
        .otherwise(F.col("key"))
    )
    return hits.select(
        *[column(k) for k in keys],
        F.col("_paper").alias("paper_id"),
        F.col("_sample").alias("sample_id"),
        per_detector(1).alias("field"),
        value.alias("value"),
        per_detector(2).alias("risk_level"),
        per_detector(4).alias("reason"),
        per_detector(5).alias("required_action"),
        per_detector(3).alias("rule_code"),
        F.lit(None).cast("double").alias("value_num"),
        (F.col("detector") + F.lit(SEQ_DUPLICATE)).alias("flag_seq"),
    ).select(*flag_columns(keys))
