"""Schema harmonisation: raw headers to canonical fields, for one table or a catalogue of tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.headers import distinct_spellings, header_text, shortened, without_brackets
from ..functions.text import column
from ..schema import P1, P2, ROW_KEY, VERSION
from ..sources.scratch import materialise
from ..sources.vocab import EXPECTED_COLUMNS, Vocabulary, alias_table, literal_rows
from .groups import gathered, made_of_gathered

DUPLICATE_SUFFIX = "__duplicate_"
SPELLINGS = 5


# The dictionary of distinct headers is broadcast up to this many bytes of header text.
BROADCAST_BYTES = 32 << 20


def _spelled_out(df: DataFrame, header: str) -> DataFrame:
    """Add the candidate spellings as ``_s0`` to ``_s4``; the two that others are made of have a projection of their own, so that each is made once."""
    c = column(header)
    texts = df.withColumns({"_s0": header_text(c), "_s1": header_text(without_brackets(c))})
    return texts.withColumns({f"_s{i}": s for i, s in enumerate(shortened(F.col("_s0"), F.col("_s1")), start=2)})


def match_headers(df: DataFrame, vocab: Vocabulary | None = None, header: str = "raw_header") -> DataFrame:
    """Add ``canonical`` (null when unknown) by spelling out and matching the header of every row.

    Row-local: the alias table, bounded by the vocabulary file, is broadcast once and
    probed with each of the five spellings. The first field in vocabulary order wins.
    """
    vocab = vocab or Vocabulary()
    aliases = F.broadcast(alias_table(df.sparkSession, vocab))
    spelled = _spelled_out(df, header)
    for i in range(SPELLINGS):
        probe = aliases.select(F.col("alias").alias(f"_s{i}"), F.col("ord").alias(f"_o{i}"))
        spelled = spelled.join(probe, f"_s{i}", "left")
    first = F.least(*[F.col(f"_o{i}") for i in range(SPELLINGS)])
    names = F.from_json(F.lit(json.dumps(vocab.canonical)), "array<string>")
    return spelled.select(*[column(c) for c in df.columns], F.get(names, first).alias("canonical"))


def map_headers(
    catalogue: DataFrame,
    vocab: Vocabulary | None = None,
    header: str = "raw_header",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``canonical`` to any frame with a header column; many rows may share a header.

    Distinct headers are matched once, written to the shared folder and measured. A small
    dictionary is broadcast back; a large one is not used, and every row is matched where
    it is. Neither way shuffles the rows, so a header in every table does no harm.
    """
    return _by_distinct(catalogue, header, lambda df, name: match_headers(df, vocab, name), broadcast_bytes)


def with_spellings(catalogue: DataFrame, header: str = "raw_header", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``spellings``: the distinct non-empty candidate spellings, sorted. Distinct headers are spelled out once, as in ``map_headers``."""

    def spell(df: DataFrame, name: str) -> DataFrame:
        listed = distinct_spellings([F.col(f"_s{i}") for i in range(SPELLINGS)])
        return _spelled_out(df, name).select(*[column(c) for c in df.columns], F.array_sort(listed).alias("spellings"))

    # a null header is in no dictionary; its one spelling is null
    unknown = F.array(F.lit(None).cast("string"))
    return _by_distinct(catalogue, header, spell, broadcast_bytes).withColumn("spellings", F.coalesce("spellings", unknown))


def _by_distinct(catalogue: DataFrame, header: str, add: Callable[[DataFrame, str], DataFrame], broadcast_bytes: int) -> DataFrame:
    distinct = catalogue.select(column(header).alias("_header")).where("_header IS NOT NULL").distinct()
    dictionary = materialise(add(distinct, "_header"), "headers")
    size = dictionary.agg(F.sum(F.octet_length("_header") + F.lit(64))).first()[0] or 0
    if size > broadcast_bytes:
        return add(catalogue, header)
    return catalogue.join(F.broadcast(dictionary), column(header) == F.col("_header"), "left").drop("_header")


def target_names(header_map: DataFrame, table_key: Sequence[str] = ("table_id",)) -> DataFrame:
    """Add ``target``: canonical or raw name, with ``__duplicate_n`` for the second and later ones.

    A made name that is taken already is counted on. One group is one header row, so it is
    bounded by the width of a table.
    """
    columns = ["position", *[c for c in header_map.columns if c != "position" and c not in table_key]]
    rows = gathered(header_map.select(*table_key, *columns), table_key, "h").withColumn("h", F.array_sort("h"))
    names = F.transform("h", lambda x: F.coalesce(x["canonical"], _named(x)))
    numbered = rows.select(*table_key, F.inline(F.arrays_zip("h", free_names(names, DUPLICATE_SUFFIX).alias("target"))))
    return numbered.select(*table_key, "h.*", "target").select(*header_map.columns, "target")


def _named(cell: Column) -> Column:
    """Raw header, or a name by position where it is blank."""
    return F.coalesce(F.nullif(cell["raw_header"], F.lit("")), F.concat(F.lit("Unnamed: "), cell["position"].cast("string")))


def free_names(names: Column, suffix: str) -> Column:
    """The names of a header row with repeated ones numbered on until they are free: ``a, a`` to ``a, a<suffix>1``."""

    def step(taken: Column, name: Column) -> Column:
        tries = F.transform(
            F.sequence(F.lit(0), F.size(taken)), lambda i: F.when(i == 0, name).otherwise(F.concat(name, F.lit(suffix), i.cast("string")))
        )
        first = F.get(F.filter(tries, lambda t: ~F.array_contains(taken, t)), F.lit(0))
        return F.concat(taken, F.array(F.when(F.array_contains(taken, name), first).otherwise(name)))

    return F.aggregate(names, F.array().cast("array<string>"), step)


def unknown_headers(header_map: DataFrame) -> DataFrame:
    return header_map.where(F.col("canonical").isNull()).drop("canonical")


def header_counts(header_map: DataFrame, table_key: Sequence[str] = ("table_id",)) -> DataFrame:
    """Per table: raw, mapped and unknown columns and canonical fields hit more than once."""
    per_field = header_map.groupBy(*table_key, "canonical").agg(F.count("*").alias("n"))
    known = F.col("canonical").isNotNull()
    return per_field.groupBy(*table_key).agg(
        F.sum("n").alias("n_raw_columns"),
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("n_mapped_columns"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_unknown_columns"),
        F.count_if(known & (F.col("n") > 1)).alias("n_duplicate_canonical_mappings"),
    )


def duplicate_targets(header_map: DataFrame, table_key: Sequence[str] = ("table_id",)) -> DataFrame:
    """Canonical fields that more than one raw header of a table maps to, with those headers."""
    known = header_map.where(F.col("canonical").isNotNull()).select(*table_key, "position", "raw_header", "canonical")
    rows = gathered(known, table_key, "h").withColumn("_fields", F.col("h.canonical"))
    hits = rows.select(*table_key, "h", F.explode(_repeated(F.col("_fields"))).alias("canonical"))
    listed = F.array_sort(F.transform(F.filter("h", lambda x: x["canonical"] == F.col("canonical")), lambda x: F.struct(x["position"], x["raw_header"])))
    counted = hits.select(*table_key, "canonical", listed.alias("_listed"))
    return counted.select(*table_key, "canonical", F.size("_listed").cast("bigint").alias("n"), F.col("_listed.raw_header").alias("raw_headers"))


def _repeated(names: Column) -> Column:
    """The names that a short array holds more than once, each once, by first repetition."""
    return F.array_distinct(F.filter(names, lambda name, i: F.array_position(names, name) <= i))


def missing_recommended(header_map: DataFrame, table_key: Sequence[str] = ("table_id",)) -> DataFrame:
    """Expected fields that no header of a table maps to, one row each.

    A pre-aggregated flag per expected field; no table list is crossed with the field list.
    """
    has = [F.max(F.coalesce(F.col("canonical") == f, F.lit(False))).alias(f"_{i}") for i, f in enumerate(EXPECTED_COLUMNS)]
    per_table = header_map.groupBy(*table_key).agg(*has)
    gaps = F.array(*[F.when(~F.col(f"_{i}"), F.lit(f)) for i, f in enumerate(EXPECTED_COLUMNS)])
    return per_table.select(*table_key, F.explode(F.array_compact(gaps)).alias("field"))


def schema_state(header_map: DataFrame, table_key: Sequence[str] = ("table_id",)) -> DataFrame:
    """One nested record per table: counts, column map, unknown columns, duplicates, gaps, warnings.

    Each list is bounded by the width of a header row. In ``column_map`` repeated and blank
    raw headers get the names that a text reader gives them (``a.1``, ``Unnamed: 3``).
    """
    rows = gathered(header_map.select(*table_key, "position", "raw_header", "canonical"), table_key, "h").withColumn("h", F.array_sort("h"))
    unique = free_names(F.transform("h", _named), ".")
    rows = rows.withColumn("h", F.zip_with("h", unique, lambda x, name: x.withField("unique", name)))
    known = F.filter("h", lambda x: x["canonical"].isNotNull())
    rows = rows.withColumn("known", known).withColumn("fields", F.col("known.canonical"))
    repeated = F.array_intersect(F.col("fields"), _repeated(F.col("fields")))  # in the order of their first headers
    per_field = F.transform(
        repeated,
        lambda name: F.struct(
            name.alias("canonical"),
            F.transform(F.filter("known", lambda x: x["canonical"] == name), lambda x: x["raw_header"]).alias("raw_headers"),
        ),
    )
    expected = F.array(*[F.lit(c) for c in EXPECTED_COLUMNS])
    out = rows.select(
        *table_key,
        "h",
        "known",
        F.transform(F.filter("h", lambda x: x["canonical"].isNull()), lambda x: x["raw_header"]).alias("unknown_columns"),
        per_field.alias("dups"),
        F.filter(expected, lambda f: ~F.array_contains("fields", f)).alias("missing_recommended_fields"),
    )
    gap_notes = F.transform(
        "missing_recommended_fields",
        lambda f: F.struct(
            F.lit(P2).alias("risk_level"), f.alias("field"), F.lit("expected field not found in the header row").alias("reason")
        ),
    )
    duplicate_notes = F.transform(
        "dups",
        lambda d: F.struct(
            F.lit(P1).alias("risk_level"),
            d["canonical"].alias("field"),
            F.concat(F.lit("several raw headers map to this field: "), F.array_join(d["raw_headers"], ", ")).alias("reason"),
        ),
    )
    return out.select(
        *table_key,
        F.lit("schema").alias("agent"),
        F.lit(VERSION).alias("version"),
        F.struct(
            F.size("h").alias("n_raw_columns"),
            F.size("known").alias("n_mapped_columns"),
            F.size("unknown_columns").alias("n_unknown_columns"),
            F.size("dups").alias("n_duplicate_canonical_mappings"),
        ).alias("summary"),
        F.map_from_arrays("known.unique", "known.canonical").alias("column_map"),
        "unknown_columns",
        F.map_from_arrays("dups.canonical", "dups.raw_headers").alias("duplicate_canonical_mappings"),
        "missing_recommended_fields",
        F.concat(gap_notes, duplicate_notes).alias("warnings"),
    )


@dataclass(frozen=True)
class HeaderPlan:
    """How the columns of one table are renamed. Bounded by the width of the table."""

    raw: tuple[str, ...]
    canonical: tuple[str | None, ...]
    targets: tuple[str, ...]
    column_map: dict[str, str] = field(default_factory=dict)
    unknown: tuple[str, ...] = ()

    @property
    def missing(self) -> list[str]:
        return [f for f in EXPECTED_COLUMNS if f not in self.canonical]

    @property
    def duplicates(self) -> dict[str, list[str]]:
        """Canonical fields with more than one raw header."""
        hits: dict[str, list[str]] = {}
        for raw, c in zip(self.raw, self.canonical):
            if c:
                hits.setdefault(c, []).append(raw)
        return {c: raw for c, raw in hits.items() if len(raw) > 1}


def plan_rows(spark: SparkSession, plan: HeaderPlan) -> DataFrame:
    """A plan as catalogue rows (table_id, position, raw_header, canonical)."""
    rows = [(0, i, raw, c) for i, (raw, c) in enumerate(zip(plan.raw, plan.canonical))]
    return literal_rows(spark, rows, "table_id int, position int, raw_header string, canonical string")


def header_rows(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    """Catalogue rows (position, raw_header) of one table."""
    return literal_rows(spark, list(enumerate(columns)), "position int, raw_header string")


def plan_headers(spark: SparkSession, columns: Sequence[str], vocab: Vocabulary | None = None) -> HeaderPlan:
    """Map the header row of one table. Runs one tiny job over its column names."""
    mapped = match_headers(header_rows(spark, columns), vocab).collect()
    canonical: list[str | None] = [None] * len(columns)
    for row in mapped:
        canonical[row["position"]] = row["canonical"]
    names = [c or raw for c, raw in zip(canonical, columns)]
    fold = (lambda s: s) if spark.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    return HeaderPlan(
        tuple(columns),
        tuple(canonical),
        tuple(deduplicated(names, fold)),
        {raw: c for raw, c in zip(columns, canonical) if c},
        tuple(raw for raw, c in zip(columns, canonical) if not c),
    )


def deduplicated(names: Sequence[str], fold=lambda s: s) -> list[str]:
    """``a, a, a`` to ``a, a__duplicate_1, a__duplicate_2``.

    ``fold`` makes names equal that the session would not tell apart.
    """
    taken: set[str] = set()
    out = []
    for name in names:
        target, n = name, 0
        while fold(target) in taken:
            n += 1
            target = f"{name}{DUPLICATE_SUFFIX}{n}"
        taken.add(fold(target))
        out.append(target)
    return out


def harmonise(
    df: DataFrame, vocab: Vocabulary | None = None, keys: Sequence[str] = ROW_KEY, plan: HeaderPlan | None = None
) -> DataFrame:
    """Rename the columns of one table to canonical names in a single select.

    Columns are taken by position, so raw headers may repeat or differ by case only.
    """
    plan = plan or plan_headers(df.sparkSession, [c for c in df.columns if c not in keys], vocab)
    at = {k: i for i, k in enumerate(df.columns) if k in keys}
    rest = [i for i, c in enumerate(df.columns) if c not in keys]
    by_place = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return by_place.select(
        *[F.col(f"_c{at[k]}").alias(k) for k in keys],
        *[F.col(f"_c{i}").alias(new) for i, new in zip(rest, plan.targets)],
    )


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Stack harmonised tables with different columns; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def cells_to_wide(
    cells: DataFrame,
    vocab: Vocabulary | None = None,
    row_key: Sequence[str] = ("table_id", "row_id"),
) -> DataFrame:
    """Long cells (row key, position, raw_header, raw_value) to one wide row of canonical fields.

    Headers are mapped without a shuffle, so a table that holds a large share of all cells
    is not gathered anywhere. Rows of the usual number of cells that stand together are made where they
    stand; other cells are shuffled by row key, joined to lists by neighbours before
    (``made_of_gathered``). A group is one table row, sorted by position inside. Of several headers that map to one field the
    leftmost fills it; the others and unknown headers are kept in ``other``, an array of
    (position, name, value), so that repeated and blank headers lose nothing.
    """
    vocab = vocab or Vocabulary()
    # The place of a field in the alphabet sorts as its name does, and is shorter.
    alphabet = sorted(vocab.canonical)
    place = F.array_position(F.array(*[F.lit(f) for f in alphabet]).cast("array<string>"), F.col("canonical")) - 1
    mapped = map_headers(cells, vocab).select(*[column(k) for k in row_key], "position", place.cast("short").alias("field"), "raw_header", "raw_value")
    names = F.from_json(F.lit(json.dumps(alphabet)), "array<string>")
    fields: list[Column] = [
        F.get("_values", F.array_position("_fields", F.lit(alphabet.index(f)).cast("short")).cast("int") - 1).alias(f) for f in vocab.canonical
    ]

    def rest(c: Column, i: Column) -> Column:
        name = F.get("_names", i)
        again = F.array_position("_names", name) <= i
        rank = F.size(F.filter(F.slice("_names", F.lit(1), i), lambda n: n == name))
        suffix = F.when(again, F.concat(F.lit(DUPLICATE_SUFFIX), rank.cast("string"))).otherwise("")
        kept = F.struct(c["position"].alias("position"), F.concat(name, suffix).alias("name"), c["raw_value"].alias("value"))
        return F.when(c["field"].isNull() | again, kept)

    def wide(rows: DataFrame, *kept: str) -> DataFrame:
        named = rows.withColumn("_cells", F.array_sort("_cells")).withColumns(
            {
                "_fields": F.col("_cells.field"),
                "_values": F.col("_cells.raw_value"),
                "_names": F.transform("_cells", lambda c: F.coalesce(F.get(names, c["field"].cast("int")), _named(c))),
            }
        )
        return named.select(*[column(k) for k in row_key], *fields, F.array_compact(F.transform("_cells", rest)).alias("other"), *kept)

    return made_of_gathered(mapped, cells, row_key, "_cells", wide)
