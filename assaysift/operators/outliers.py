"""Values unlike those of the other samples of the same paper.

A value is compared with the median of its paper and field, in units of the median absolute deviation,
both exact. A median is found without gathering its group: values are counted by narrow steps, with
map-side combining, and only those inside the step of the median are looked at again and ranked. Where
a step holds too many rows for that, a mergeable quantile sketch brackets the median more closely. So a
paper with very many rows is split over tasks like any other rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import column, norm_key, number_text, text_or_blank
from ..functions.units import NUMERIC_FIELDS
from ..schema import P1, ROW_KEY, SEQ_OUTLIER
from ..sources.scratch import materialise
from .groups import BROADCAST_GROUPS, with_group_values
from .validate import flag_columns, number_or_null

ACCURACY = 10_000  #: of the sketch; a bracket holds about 6 / ACCURACY of its group's rows, or a few values
STEPS = 128  #: to a doubling of the value; more would leave little to combine where values hardly repeat
BRACKET_ROWS = 1_000_000  #: a step with more rows of a group is left to the sketch, so fewer groups than a millionth of the values need one
MINIMUM = 5  #: fewer values of a paper and field say nothing about any of them
LIMIT = 3.5  #: deviations beyond which a value is unlike the others
SCALE = 1.4826  #: standard deviations of normal values in one median absolute deviation

GROUP = ("paper_key", "field_pos")


def _step(v: Column) -> Column:
    """Number of a narrow range of values, in the order of the values: ``STEPS`` to a doubling, zero by itself."""
    at = F.floor(F.least(F.log2(F.abs(v)), F.lit(1_100.0)) * STEPS) + 1_200 * STEPS  # above zero for every double
    return F.when(v == 0, F.lit(0)).when(v > 0, at).otherwise(-at)


def exact_medians(values: DataFrame, group: Sequence[str], value: str, accuracy: int = ACCURACY, broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """(group, n, median) of finite numbers; the mean of the two middle values of an even number. Stored."""
    group, slack, v = list(group), min(0.5, 3 / accuracy), F.col(value)
    steps = values.groupBy(*group, _step(v).alias("step")).agg(F.count("*").alias("rows"), F.min(v).alias("low"), F.max(v).alias("high"))
    own = Window.partitionBy(*group)
    upto = F.sum("rows").over(own.orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    steps = steps.select(*group, "rows", "low", "high", upto.alias("upto"), F.sum("rows").over(own).alias("n"))
    at = lambda rank: F.min(F.when(F.col("upto") > rank, F.struct("upto", "rows", "low", "high")))
    middle = steps.groupBy(*group, "n").agg(at(F.expr("(n - 1) div 2")).alias("a"), at(F.expr("n div 2")).alias("b"))
    single = F.expr("a.low = a.high AND b.low = b.high")  # one value a step, which is the median's
    placed = materialise(
        middle.select(
            *group, "n", F.col("a.low").alias("low"), F.col("b.high").alias("high"), F.expr("b.upto - a.upto + a.rows").alias("inside"),
            F.when(single, (F.col("a.low") + F.col("b.low")) / 2).alias("median"),
        ),
        "steps",
    )
    known = placed.where("median IS NOT NULL").select(*group, "n", "median")
    wide = F.col("inside") > BRACKET_ROWS
    left = placed.where("median IS NULL").agg(F.count("*").alias("groups"), F.count_if(wide).alias("wide")).first()
    if not left["groups"]:
        return known
    brackets = placed.where("median IS NULL").select(*group, "n", "low", "high", wide.alias("wide"))
    if left["wide"]:  # more values than this in a step: few groups, whatever the size of the data, get a sketch
        rows = values.join(F.broadcast(brackets.where("wide").select(*group)), group, "left_semi")
        sketched = rows.groupBy(*group).agg(F.count("*").alias("n"), F.percentile_approx(value, [0.5 - slack, 0.5 + slack], accuracy).alias("around"))
        sketched = sketched.select(*group, "n", F.col("around")[0].alias("low"), F.col("around")[1].alias("high"))
        brackets = materialise(brackets.where("NOT wide").drop("wide").unionByName(sketched), "brackets")
    found = _ranked(values, brackets.drop("wide"), group, value, broadcast_groups)
    missed = found.where("median IS NULL")
    if missed.limit(1).count():  # a sketch that is off: rank all values of the group
        whole = missed.select(*group, "n", F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"))
        again = _ranked(values.join(F.broadcast(missed.select(*group)), group, "left_semi") if missed.count() <= broadcast_groups else values.join(missed.select(*group), group, "left_semi"),
                        materialise(whole, "brackets"), group, value, broadcast_groups)
        found = found.where("median IS NOT NULL").unionByName(again)
    return materialise(known.unionByName(found), "medians")


def _ranked(values: DataFrame, brackets: DataFrame, group: list[str], value: str, broadcast_groups: int) -> DataFrame:
    """Medians by counting distinct values inside the brackets; null where a bracket misses a middle rank."""
    placed = with_group_values(values.select(*group, value), brackets, group, broadcast_groups=broadcast_groups)
    v = F.col(value)
    counts = placed.where(v <= F.col("high")).select(*group, "n", F.when(v >= F.col("low"), v).alias("v"))  # null: below the bracket
    counts = counts.groupBy(*group, "n", "v").agg(F.count("*").alias("rows"))
    upto = Window.partitionBy(*group).orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("upto", F.sum("rows").over(upto))
    at = lambda rank: F.min(F.when(F.col("upto") > rank, F.struct(F.col("upto").alias("upto"), F.col("v").alias("v"))))["v"]
    middle = ranked.groupBy(*group, "n").agg(at(F.expr("(n - 1) div 2")).alias("a"), at(F.expr("n div 2")).alias("b"))
    both = brackets.select(*group, "n").join(middle.select(*group, "a", "b"), group, "left")
    return materialise(both.select(*group, "n", ((F.col("a") + F.col("b")) / 2).alias("median")), "medians")


def _wide(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> tuple[DataFrame, list[int]]:
    """Rows with a paper, their key in ``row`` and the finite value of field i in ``v{i}``; and the places of the fields there are."""
    types = {f.name: f.dataType for f in df.schema.fields}
    places = [i for i, f in enumerate(fields) if f in types] if "paper_id" in types else []
    numbers = [number_or_null(column(fields[i]), types[fields[i]]).alias(f"v{i}") for i in places]
    if not places:
        places, numbers = [0], [F.lit(None).cast("double").alias("v0")]
    paper = norm_key(column("paper_id"), types["paper_id"]) if "paper_id" in types else F.lit("")
    shown, sample = (text_or_blank(column(c), types[c]) if c in types else F.lit("") for c in ("paper_id", "sample_id"))
    row = F.struct(*[column(k) for k in keys]).alias("row")  # so that no key has the name of a column here
    named = df.select(row, paper.alias("paper_key"), shown.alias("paper_id"), sample.alias("sample_id"), *numbers).where("paper_key <> ''")
    finite = [F.when(F.abs(f"v{i}") < float("inf"), F.col(f"v{i}")).alias(f"v{i}") for i in places]
    return named.select("row", "paper_key", "paper_id", "sample_id", *finite), places


def _long(wide: DataFrame, others: Sequence[str], cells: Sequence[Column]) -> DataFrame:
    """A row per cell that is not null. The array is made by a projection, in compiled code; inside the generator it would be interpreted."""
    return wide.select(*others, F.array(*cells).alias("cells")).select(*others, F.explode_outer("cells").alias("c")).where("c IS NOT NULL").select(*others, "c.*")


def _cells(places: Sequence[int], name: str, value: Callable[[int], Column]) -> list[Column]:
    return [F.when(value(i).isNotNull(), F.struct(F.lit(i).alias("field_pos"), value(i).alias(name))) for i in places]


def _by_paper(groups: DataFrame, places: Sequence[int], **values: str) -> DataFrame:
    """A row per paper with the values of its fields side by side, so that a table row meets them all in one lookup. Stored."""
    of = [F.max(F.when(F.col("field_pos") == i, F.col(c))).alias(f"{short}{i}") for short, c in values.items() for i in places]
    return materialise(groups.groupBy("paper_key").agg(F.max("n").alias("n"), *of), "papers")


def paper_values(df: DataFrame, keys: Sequence[str] = ROW_KEY, fields: Sequence[str] = NUMERIC_FIELDS) -> DataFrame:
    """A row per finite value of a paper, its key in ``row``; papers are compared as duplicates are, rows without a paper are left out."""
    wide, places = _wide(df, keys, fields)
    return _long(wide, ("row", "paper_key", "paper_id", "sample_id"), _cells(places, "v", lambda i: F.col(f"v{i}")))


def paper_outliers(
    df: DataFrame, keys: Sequence[str] = ROW_KEY, fields: Sequence[str] = NUMERIC_FIELDS, *, minimum: int = MINIMUM, limit: float = LIMIT,
    accuracy: int = ACCURACY, broadcast_groups: int = BROADCAST_GROUPS,
) -> DataFrame:
    """P1 flags of a cleaned table: values further than ``limit`` scaled deviations from their paper's median.

    Read several times, so ``df`` should be stored. Papers with fewer than ``minimum`` values of a field,
    and fields of which at least half the values are equal, have no outliers.
    """
    wide, places = _wide(df, keys, fields)
    distance = lambda i: F.abs(F.col(f"v{i}") - F.col(f"m{i}"))
    values = _long(wide, ("paper_key",), _cells(places, "v", lambda i: F.col(f"v{i}")))
    usual = exact_medians(values, GROUP, "v", accuracy, broadcast_groups).where(F.col("n") >= minimum)
    middles = _by_paper(usual, places, m="median")
    near = with_group_values(wide.select("paper_key", *[f"v{i}" for i in places]), middles, ("paper_key",), broadcast_groups=broadcast_groups)
    apart = _long(near, ("paper_key",), _cells(places, "apart", distance))
    spread = exact_medians(apart, GROUP, "apart", accuracy, broadcast_groups)
    known = usual.join(spread.select(*GROUP, F.col("median").alias("spread")), list(GROUP)).where("spread > 0")
    spreads = _by_paper(known.withColumn("count", F.col("n")), places, m="median", s="spread", c="count")
    known = with_group_values(wide, spreads, ("paper_key",), broadcast_groups=broadcast_groups)
    cells = [
        F.when(
            distance(i) > F.col(f"s{i}") * SCALE * limit,
            F.struct(F.lit(i).alias("field_pos"), F.col(f"v{i}").alias("v"), F.col(f"m{i}").alias("median"), F.col(f"c{i}").alias("n")),
        )
        for i in places
    ]
    found = _long(known, ("row", "paper_id", "sample_id"), cells)
    names = F.array(*[F.lit(f) for f in fields])
    reason = F.concat(F.lit("far from the paper's median of "), number_text(F.col("median")), F.lit(" over "), F.col("n").cast("string"), F.lit(" values"))
    return found.select(
        *[F.col("row")[k].alias(k) for k in keys], "paper_id", "sample_id", F.get(names, F.col("field_pos")).alias("field"), number_text(F.col("v")).alias("value"),
        F.lit(P1).alias("risk_level"), reason.alias("reason"), F.lit("compare with the paper's other samples before using the value").alias("required_action"),
        F.lit("paper_outlier").alias("rule_code"), F.col("v").alias("value_num"), (F.lit(SEQ_OUTLIER) + F.col("field_pos")).cast("int").alias("flag_seq"),
    ).select(*flag_columns(keys))
