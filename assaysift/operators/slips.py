"""Sample names of one paper that differ by a slip of the pen.

Names are compared as duplicates are, once each, whatever the number of their rows. Two names of a paper
are linked if their numbers agree and at most ``distance`` letters must be put in, left out or changed to
make one the other. Every name is listed under itself and what is left of it after up to ``distance``
deletions; names within the distance share such an entry, so an equi-join on (paper, numbers, entry)
finds them all, and no task gets a whole paper. Linked names are joined to classes by passing on the
smallest name, round by round, with a jump to the class of one's class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import column, norm_key, text_or_blank
from ..schema import P2, ROW_KEY, SEQ_SLIP
from ..sources.scratch import materialise
from .groups import BROADCAST_GROUPS, with_group_values
from .validate import flag_columns

DISTANCE = 1
MINIMUM = 4  #: letters; of shorter names every one is near many others

GROUP = ("paper_key", "name_key")


def _entries(name: Column, distance: int) -> Column:
    """Hashes of the name and of all that up to ``distance`` deletions leave of it: about length ** distance of them."""

    def without_one(text: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
        return F.transform(places, lambda i: F.concat(F.left(text, i - 1), text.substr(i + 1, F.length(text))))

    level, every = F.array(name), F.array(name)
    for _ in range(distance):
        level = F.array_distinct(F.flatten(F.transform(level, without_one)))
        every = F.concat(every, level)
    return F.array_distinct(F.transform(every, lambda t: F.xxhash64(t)))


def _named_rows(df: DataFrame, keys: Sequence[str], minimum: int) -> DataFrame:
    """Rows with a paper and a name of at least ``minimum`` letters; the key in ``row``, so that it clashes with nothing."""
    types = {f.name: f.dataType for f in df.schema.fields}
    key = lambda c: norm_key(column(c), types[c]) if c in types else F.lit("")
    shown = lambda c: text_or_blank(column(c), types[c]) if c in types else F.lit("")
    row = F.struct(*[column(k) for k in keys]).alias("row")
    rows = df.select(
        row, key("paper_id").alias("paper_key"), key("sample_name").alias("name_key"),
        *[shown(c).alias(c) for c in ("paper_id", "sample_id", "sample_name")],
    )
    return rows.where((F.col("paper_key") != "") & (F.length("name_key") >= minimum))


def name_links(names: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(paper_key, a, b) for every two names within the distance, each way round."""
    numbers = F.trim(F.regexp_replace("name_key", "[^0-9]+", " "))
    entries = names.select("paper_key", numbers.alias("numbers"), "name_key", F.explode(_entries(F.col("name_key"), distance)).alias("entry"))
    at = ["paper_key", "numbers", "entry"]
    met = entries.withColumnRenamed("name_key", "a").join(entries.withColumnRenamed("name_key", "b"), at)
    near = F.levenshtein("a", "b", distance)  # -1 beyond it
    return met.where((F.col("a") != F.col("b")) & (near >= 0)).select("paper_key", "a", "b").distinct()


def _classes(links: DataFrame) -> DataFrame:
    """(paper_key, name_key, component, n_links) of linked names; the component is its smallest name."""
    counts = links.groupBy("paper_key", F.col("a").alias("name_key")).agg(F.count("*").alias("n_links"), F.min("b").alias("least"))
    found = materialise(counts.select("paper_key", "name_key", "n_links", F.least("name_key", "least").alias("component")), "classes")
    while True:
        own = found.select("paper_key", F.col("name_key").alias("b"), F.col("component").alias("theirs"))
        near = links.join(own, ["paper_key", "b"]).groupBy("paper_key", F.col("a").alias("name_key")).agg(F.min("theirs").alias("near"))
        jump = own.select("paper_key", F.col("b").alias("component"), F.col("theirs").alias("further"))
        moved = found.join(near, list(GROUP)).join(jump, ["paper_key", "component"])
        least = F.least("component", "near", "further")
        moved = materialise(moved.select(*GROUP, "n_links", least.alias("component"), (least != F.col("component")).alias("changed")), "classes")
        found = moved.drop("changed")
        if not moved.where("changed").limit(1).count():
            return found


def name_classes(
    df: DataFrame, keys: Sequence[str] = ROW_KEY, *, distance: int = DISTANCE, minimum: int = MINIMUM
) -> DataFrame:
    """(paper_key, name_key, n rows, component, n_links) of every name; one without links is its own class.

    Missing papers and names, and names of fewer than ``minimum`` letters, are left out. Stored.
    """
    names = _named_rows(df, keys, max(minimum, distance + 1)).groupBy(*GROUP).agg(F.count("*").alias("n"))
    names = materialise(names, "names")
    classes = _classes(materialise(name_links(names, distance), "links"))
    both = names.join(classes, list(GROUP), "left")
    component, n_links = F.coalesce("component", "name_key"), F.coalesce("n_links", F.lit(0))
    return materialise(both.select(*GROUP, "n", component.alias("component"), n_links.alias("n_links")), "name-classes")


def name_slips(
    df: DataFrame, keys: Sequence[str] = ROW_KEY, *, distance: int = DISTANCE, minimum: int = MINIMUM, broadcast_groups: int = BROADCAST_GROUPS
) -> DataFrame:
    """P2 flags of a cleaned table: rows whose sample name has a near spelling in its paper.

    Read twice, so ``df`` should be stored.
    """
    linked = name_classes(df, keys, distance=distance, minimum=minimum).where("n_links > 0")
    found = with_group_values(_named_rows(df, keys, max(minimum, distance + 1)), linked, GROUP, broadcast_groups=broadcast_groups)
    return found.select(
        *[F.col("row")[k].alias(k) for k in keys], "paper_id", "sample_id", F.lit("sample_name").alias("field"), F.col("sample_name").alias("value"),
        F.lit(P2).alias("risk_level"), F.concat(F.lit("the paper spells this name in other ways, among them "), "component").alias("reason"),
        F.lit("give one sample one name, or make the difference plain").alias("required_action"), F.lit("name_slip").alias("rule_code"),
        F.lit(None).cast("double").alias("value_num"), F.lit(SEQ_SLIP).alias("flag_seq"),
    ).select(*flag_columns(keys))
