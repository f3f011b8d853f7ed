"""Units that can't be read, or that don't fit the field they stand in, as flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dimensions import bare_unit, degrees, parsed_unit, unit_of
from ..functions.text import column, text_or_blank
from ..functions.units import NUMERIC_FIELDS
from ..schema import P1, P2, ROW_KEY, SEQ_UNIT
from ..sources.scratch import materialise
from ..sources.vocab import RuleSet
from .groups import BROADCAST_GROUPS, with_group_values
from .validate import flag_columns

#: Length fields in which a bare ``a`` is read as Angstrom, as the conversions do.
ANGSTROM_FIELDS = ("d002_nm",)
_DIMENSIONLESS = " ".join("0" * 6)


def cell_units(df: DataFrame, keys: Sequence[str] = ROW_KEY, fields: Sequence[str] = NUMERIC_FIELDS) -> DataFrame:
    """A row per text cell of a numeric field that has a unit: row (its key), paper_id, sample_id, field_pos, value, unit."""
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = [(i, f) for i, f in enumerate(fields) if isinstance(types.get(f), T.StringType)]
    unit = lambda c: F.when(c.rlike(r"\p{Nd}"), bare_unit(c)).alias("unit")
    cells = F.array(*[F.struct(F.lit(i).alias("field_pos"), column(f).alias("value"), unit(column(f))) for i, f in texts])
    if not texts:
        cells = F.array(F.lit(None).cast("struct<field_pos:int,value:string,unit:string>"))
    ids = [(text_or_blank(column(c), types[c]) if c in types else F.lit("")).alias(c) for c in ("paper_id", "sample_id")]
    row = F.struct(*[column(k) for k in keys]).alias("row")  # so that no key has the name of a column here
    # Units are searched in a projection below an outer generator: no filter on them moves there to search them again.
    listed = df.select(row, *ids, cells.alias("cells"))
    long = listed.select("row", "paper_id", "sample_id", F.inline_outer("cells")).where("unit <> ''").withColumn("unit", degrees(F.col("unit")))
    angstrom = F.col("field_pos").isin(*[fields.index(f) for f in ANGSTROM_FIELDS if f in fields]) & (F.col("unit") == "a")
    return long.withColumn("unit", F.when(angstrom, F.lit("å")).otherwise(F.col("unit")))


def unit_table(cells: DataFrame, fields: Sequence[str] = NUMERIC_FIELDS, rules: RuleSet | None = None) -> DataFrame:
    """(field_pos, unit, n, dimension, factor, expected) of every distinct unit of a field; each is parsed once."""
    rules = rules or RuleSet()
    wanted = cells.sparkSession.createDataFrame([(i, rules.bounds[f].unit if f in rules.bounds else "") for i, f in enumerate(fields)], "field_pos int, own string")
    wanted = wanted.select("field_pos", F.coalesce(parsed_unit(unit_of(F.col("own")))["dimension"], F.lit(_DIMENSIONLESS)).alias("expected"))
    units = cells.groupBy("field_pos", "unit").agg(F.count("*").alias("n"))
    parsed = units.withColumn("p", parsed_unit(F.col("unit"))).join(F.broadcast(wanted), "field_pos")
    return parsed.select("field_pos", "unit", "n", F.col("p.dimension").alias("dimension"), F.col("p.factor").alias("factor"), "expected")


def unit_flags(
    df: DataFrame, keys: Sequence[str] = ROW_KEY, fields: Sequence[str] = NUMERIC_FIELDS, rules: RuleSet | None = None, broadcast_groups: int = BROADCAST_GROUPS
) -> DataFrame:
    """Flags of a table with canonical headers and texts as they were read, before numbers are parsed.

    P1 ``unit_mismatch``: a unit of another dimension than that of the field's own unit, so no factor
    could make it right. P2 ``unit_unread``: the text beside the number is no unit. Cells without a
    number or without a unit are not flagged. Read twice, so ``df`` should be stored.
    """
    cells = cell_units(df, keys, fields)
    misfits = unit_table(cells, fields, rules).where("dimension IS NULL OR dimension <> expected")
    found = with_group_values(cells, materialise(misfits, "units"), ("field_pos", "unit"), broadcast_groups=broadcast_groups)
    unread = F.col("dimension").isNull()
    say = lambda a, b: F.when(unread, F.lit(a)).otherwise(F.lit(b))
    return found.select(
        *[F.col("row")[k].alias(k) for k in keys], "paper_id", "sample_id", F.get(F.array(*[F.lit(f) for f in fields]), F.col("field_pos")).alias("field"), "value",
        say(P2, P1).alias("risk_level"), F.concat(say("cannot read as a unit: ", "measures something else than the field: "), F.col("unit")).alias("reason"),
        say("write the unit out or correct it", "move the value to its field or correct the unit").alias("required_action"),
        say("unit_unread", "unit_mismatch").alias("rule_code"), F.lit(None).cast("double").alias("value_num"),
        (F.lit(SEQ_UNIT) + F.col("field_pos")).cast("int").alias("flag_seq"),
    ).select(*flag_columns(keys))
