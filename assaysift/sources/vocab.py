"""Canonical vocabulary and rule bounds, as data with optional override files.

Both are small driver-side configuration. They enter plans as literals or as literal
tables, so what gets broadcast is bounded by the configuration file, not by the data.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.headers import alias_text

# Canonical fields in matching order, each with its header spellings.
FIELD_ALIASES: dict[str, tuple[str, ...]] = {
    "paper_id": ("paper", "paper_id", "paper id", "reference", "ref", "doi", "article_id", "article id", "source paper"),
    "sample_id": ("sample_id", "sample id", "id", "record_id", "record id", "material_id", "material id"),
    "sample_name": ("sample", "sample name", "material", "material name", "electrode material", "sample code", "sample label"),
    "precursor": ("precursor", "biomass", "raw material", "feedstock", "carbon source", "precursor type"),
    "material_type": ("material_type", "material type", "type", "category", "carbon type", "system", "application"),
    "carbonization_temperature_C": (
        "carbonization temperature", "pyrolysis temperature", "temperature", "temp", "carbonization temp",
        "carbonization_temp", "carbonization_temperature", "carbonization temperature c", "pyrolysis temp",
    ),
    "BET_m2_g": (
        "BET", "SSA", "S_BET", "SBET", "surface area", "specific surface area", "BET surface area", "BET area",
        "specific surface area m2/g",
    ),
    "d002_nm": ("d002", "d_002", "interlayer spacing", "layer spacing", "interlayer distance", "d-spacing", "d spacing"),
    "ID_IG": ("ID/IG", "I_D/I_G", "IDIG", "id ig", "raman ratio", "Raman ID/IG", "raman id ig"),
    "XPS_N_at_pct": ("N", "N content", "nitrogen content", "N at%", "XPS N", "XPS_N", "nitrogen at%", "atomic n"),
    "XPS_O_at_pct": ("O", "O content", "oxygen content", "O at%", "XPS O", "XPS_O", "oxygen at%", "atomic o"),
    "pore_volume_cm3_g": ("pore volume", "total pore volume", "V_total", "total pore volume cm3/g", "total pore volume cm3 g-1"),
    "micropore_volume_cm3_g": ("micropore volume", "V_micro", "micropore volume cm3/g", "micro pore volume"),
    "mass_loading_mg_cm2": ("mass loading", "loading", "electrode loading", "active mass loading", "active material loading"),
    "electrode_thickness_um": ("electrode thickness", "thickness", "film thickness"),
    "compacted_density_g_cm3": ("compacted density", "tap density", "electrode density", "density", "packing density"),
    "ICE_pct": (
        "ICE", "initial coulombic efficiency", "first coulombic efficiency", "initial CE", "first CE",
        "coulombic efficiency 1st",
    ),
    "capacity_mAh_g": (
        "capacity", "reversible capacity", "specific capacity", "discharge capacity", "charge capacity", "capacity mAh/g",
    ),
    "capacitance_F_g": ("capacitance", "specific capacitance", "gravimetric capacitance", "capacitance F/g"),
    "current_density_A_g": ("current density", "current", "rate", "test current", "current density A/g"),
    "voltage_window_V": ("voltage window", "potential window", "voltage range", "voltage"),
    "electrolyte": ("electrolyte", "electrolyte type", "electrolyte system"),
    "source_location": (
        "source", "source location", "table", "figure", "SI", "note", "extraction note", "page", "source note",
        "original location",
    ),
}

# Fields whose absence from a whole table is worth a note.
EXPECTED_COLUMNS = ("paper_id", "sample_id", "sample_name", "source_location")


@dataclass(frozen=True)
class Bounds:
    """Hard and soft limits of one field; ``None`` means no limit."""

    hard_min: float | None = None
    hard_max: float | None = None
    soft_min: float | None = None
    soft_max: float | None = None
    unit: str = ""


# Physical limits per field, in checking order.
FIELD_BOUNDS: dict[str, Bounds] = {
    "carbonization_temperature_C": Bounds(hard_min=100, hard_max=3000, soft_min=400, soft_max=1600, unit="°C"),
    "BET_m2_g": Bounds(hard_min=0, hard_max=10000, soft_max=4000, unit="m2/g"),
    "d002_nm": Bounds(hard_min=0.30, hard_max=1.0, soft_min=0.335, soft_max=0.50, unit="nm"),
    "ID_IG": Bounds(hard_min=0, soft_max=3.5),
    "XPS_N_at_pct": Bounds(hard_min=0, hard_max=100, soft_max=30, unit="at%"),
    "XPS_O_at_pct": Bounds(hard_min=0, hard_max=100, soft_max=50, unit="at%"),
    "pore_volume_cm3_g": Bounds(hard_min=0, hard_max=20, soft_max=5, unit="cm3/g"),
    "micropore_volume_cm3_g": Bounds(hard_min=0, hard_max=10, soft_max=3, unit="cm3/g"),
    "mass_loading_mg_cm2": Bounds(hard_min=0, hard_max=100, soft_min=0.1, soft_max=20, unit="mg/cm2"),
    "electrode_thickness_um": Bounds(hard_min=0, soft_max=1000, unit="um"),
    "compacted_density_g_cm3": Bounds(hard_min=0, hard_max=5, soft_max=2.5, unit="g/cm3"),
    "ICE_pct": Bounds(hard_min=0, hard_max=100, unit="%"),
    "capacity_mAh_g": Bounds(hard_min=0, hard_max=5000, soft_max=2000, unit="mAh/g"),
    "capacitance_F_g": Bounds(hard_min=0, hard_max=3000, soft_max=1000, unit="F/g"),
    "current_density_A_g": Bounds(hard_min=0, soft_max=100, unit="A/g"),
}

# Fields every row should fill, with the bundled rules and without any rules.
RECOMMENDED_FIELDS = ("paper_id", "sample_id", "sample_name", "source_location")
RECOMMENDED_WITHOUT_RULES = ("source_location",)


@dataclass(frozen=True)
class Vocabulary:
    """Canonical fields and their spellings; the order of fields decides ties."""

    aliases: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: dict(FIELD_ALIASES))

    @property
    def canonical(self) -> list[str]:
        return list(self.aliases)

    def spellings(self) -> list[tuple[str, int]]:
        """(spelling, position of its field); a canonical name is a spelling of itself."""
        return [
            (str(text), ord_)
            for ord_, (name, texts) in enumerate(self.aliases.items())
            for text in (name, *texts)
            if str(text).strip()
        ]


@dataclass(frozen=True)
class RuleSet:
    bounds: Mapping[str, Bounds] = field(default_factory=lambda: dict(FIELD_BOUNDS))
    recommended: tuple[str, ...] = RECOMMENDED_FIELDS


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A small table from one JSON literal, without a Python worker or a job of its own."""
    names = [part.split()[0] for part in schema.split(", ")]
    text = json.dumps([dict(zip(names, row)) for row in rows], ensure_ascii=False)
    return spark.range(1, numPartitions=1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{_ddl(schema)}>>")))


def _ddl(schema: str) -> str:
    return ", ".join(":".join(part.split()) for part in schema.split(", "))


def alias_table(spark: SparkSession, vocab: Vocabulary | None = None) -> DataFrame:
    """``alias_dim(alias, ord)``: normalised spelling and position of the first field that has it."""
    raw = literal_rows(spark, (vocab or Vocabulary()).spellings(), "spelling string, ord int")
    return (
        raw.select(alias_text(F.col("spelling")).alias("alias"), "ord").where("alias <> ''").groupBy("alias").agg(F.min("ord").alias("ord"))
    )


def rule_table(spark: SparkSession, rules: RuleSet | None = None) -> DataFrame:
    """``rule_dim(field, ord, hard_min, hard_max, soft_min, soft_max, unit)``."""
    bounds = (rules or RuleSet()).bounds
    rows = [(name, i, b.hard_min, b.hard_max, b.soft_min, b.soft_max, b.unit) for i, (name, b) in enumerate(bounds.items())]
    schema = "field string, ord int, hard_min double, hard_max double, soft_min double, soft_max double, unit string"
    return literal_rows(spark, rows, schema)


def vocabulary_from(data: Mapping | None) -> Vocabulary:
    """Vocabulary from parsed configuration: ``canonical_fields: {name: {aliases: [...]}}``."""
    fields = (data or {}).get("canonical_fields", {})
    return Vocabulary({str(name): tuple(str(a) for a in (spec or {}).get("aliases", [])) for name, spec in fields.items()})


def rules_from(data: Mapping | None) -> RuleSet:
    """Rules from parsed configuration: ``rules: {field: bounds}`` and ``recommended_fields: [...]``."""
    data = data or {}
    known = ("hard_min", "hard_max", "soft_min", "soft_max", "unit")
    bounds = {
        str(name): Bounds(**{k: v for k, v in (spec or {}).items() if k in known})
        for name, spec in data.get("rules", {}).items()
    }
    return RuleSet(bounds, tuple(data.get("recommended_fields", RECOMMENDED_WITHOUT_RULES)))


def _read_config(spark: SparkSession, path: str) -> Mapping | None:
    """One small YAML or JSON file, read through Spark so that any file system works."""
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    text = rows[0][0] if rows else ""
    try:
        import yaml
    except ImportError:
        return json.loads(text) if text.strip() else None
    return yaml.safe_load(text)


def load_vocabulary(spark: SparkSession, path: str | None = None) -> Vocabulary:
    return vocabulary_from(_read_config(spark, path)) if path else Vocabulary()


def load_rules(spark: SparkSession, path: str | None = None) -> RuleSet:
    return rules_from(_read_config(spark, path)) if path else RuleSet()
