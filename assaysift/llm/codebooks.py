"""Vectors as short codes: Lloyd rounds over parts that stay where their entry lives.

A vector's whole-number components are cut into 16 equal parts, and every part position has a codebook
of its own. The parts are dealt out once, by (position, entry, salt): an owner holds the parts of one
position that its entry is nearest to, and the salt splits an entry that very many parts share. From
then on an owner's sums follow its members: each round owners compare their resident parts with the
new entries, only parts whose entry changes are shuffled to their next owners, and those sums lose what
leaves and gain what arrives. All arithmetic is on whole numbers, so results don't depend on order.
Codebooks are 64 entries a position, whatever the data; they alone pass through the driver.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, parts_for, stored, table

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
OWNER_ROWS = 50_000  #: an owner holds about so many members at most
TASK_ROWS = 200_000  #: parts a task of the first deal
SETTLE = 4  #: after so many rounds the members are written anew, so that no part is compared again for every round

_LIMIT = 1 << 24  # of a component's whole number, so that squared distances stay exact
_BROADCAST_LABELS = 100_000
_HOT_LABELS = 1_000


def _usable(vector: Column) -> Column:
    """Not null, without null, non-finite or huge components, of a length that can be cut."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) < _LIMIT, F.lit(False)))
    return vector.isNotNull() & (F.size(vector) > 0) & (F.size(vector) % PARTS == 0) & fine


def _nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the lowest of equals, and the squared distance; exact."""
    top = max(int(np.abs(parts).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if 4 * top * top * parts.shape[1] < 1 << 52 else np.int64
    x, c = parts.astype(kind), entries.astype(kind)
    near, far = np.empty(len(x), np.int32), np.empty(len(x), np.int64)
    for at in range(0, len(x), 8_192):
        own = x[at : at + 8_192]
        distance = (own * own).sum(1)[:, None] - 2 * (own @ c.T) + (c * c).sum(1)
        best = distance.argmin(1)
        near[at : at + 8_192], far[at : at + 8_192] = best, distance[np.arange(len(own)), best]
    return near, far


def _by_position(position: np.ndarray, parts: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    near, far = np.empty(len(position), np.int32), np.empty(len(position), np.int64)
    for p in np.unique(position).tolist():
        here = position == p
        near[here], far[here] = _nearest(parts[here], books[p])
    return near, far


_MEMBER = "row bigint, position int, entry int, part array<int>"


def _lists(parts: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(parts) + 1, dtype=np.int32) * parts.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(parts.astype(np.int32).ravel()))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def _first_members(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """A row per part of every vector, with its nearest entry."""
    width = books.shape[2]

    def run(batches: Batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 4_096):
                batch = whole.slice(at, 4_096)
                parts = _matrix(batch.column(1), width)
                position = np.tile(np.arange(PARTS, dtype=np.int32), batch.num_rows)
                row = np.repeat(batch.column(0).to_numpy(), PARTS)
                columns = [pa.array(row), pa.array(position), pa.array(_by_position(position, parts, books)[0]), _lists(parts)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "position", "entry", "part"])

    return kept.select("row", "vector").mapInArrow(run, _MEMBER)


def _compared(members: DataFrame, books: np.ndarray) -> DataFrame:
    """Members with ``nearest``, the entry that is nearest now, and ``error``, its squared distance; where they are."""
    width = books.shape[2]

    def run(batches: Batches):
        for batch in batches:
            if batch.num_rows:
                near, far = _by_position(batch.column(1).to_numpy(), _matrix(batch.column(3), width), books)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near), pa.array(far)], names=["row", "position", "entry", "part", "nearest", "error"])

    return members.select("row", "position", "entry", "part").mapInArrow(run, f"{_MEMBER}, nearest int, error bigint")


def _owned(members: DataFrame, salts: int, rows: int) -> DataFrame:
    """Shuffled to their owners, (position, entry, salt), and stored there."""
    dealt = members.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
    dealt = dealt.repartition(parts_for(rows, TASK_ROWS), "position", "entry", "salt").sortWithinPartitions("position", "entry", "salt")
    return stored(dealt, "codes-members")


def _sums(members: DataFrame, width: int, entry: str = "entry") -> tuple[np.ndarray, np.ndarray]:
    """Number of members and componentwise sum of every entry of every position."""
    n, total = np.zeros((PARTS, ENTRIES), np.int64), np.zeros((PARTS, ENTRIES, width), np.int64)
    each = [F.sum(F.get("part", F.lit(i)).cast("bigint")).alias(f"s{i}") for i in range(width)]
    for r in members.groupBy("position", F.col(entry).alias("e")).agg(F.count("*").alias("n"), *each).collect():  # at most 16 * 64 rows
        n[r["position"], r["e"]] = r["n"]
        total[r["position"], r["e"]] = [r[f"s{i}"] for i in range(width)]
    return n, total


def _updated(books: np.ndarray, n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Each entry by the floor of its members' mean; entries without members stay."""
    return np.where(n[:, :, None] > 0, total // np.maximum(n, 1)[:, :, None], books)


def _settled(members: DataFrame, books: np.ndarray, rounds: int, salts: int, rows: int) -> tuple[DataFrame, np.ndarray]:
    """The members after ``rounds`` rounds, and the codebooks."""
    width, entries = books.shape[2], books.shape[1]
    n, total = _sums(members, width)
    for done in range(1, rounds + 1):
        books = _updated(books, n[:, :entries], total[:, :entries])
        if done == rounds:
            break
        compared = _compared(members, books)
        moved = compared.where("entry <> nearest").select("row", "position", F.col("nearest").alias("entry"), F.col("entry").alias("old"), "part")
        moved = _owned(moved, salts, rows)
        (n_in, total_in), (n_out, total_out) = _sums(moved, width), _sums(moved, width, "old")
        n, total = n + n_in - n_out, total + total_in - total_out
        stay = compared.where("entry = nearest").select("row", "position", "entry", "part")
        members = stay.unionByName(moved.select("row", "position", "entry", "part"))
        if done % SETTLE == 0:
            members = stored(members, "codes-settled")
    return members, books


def _label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with the error summed over equal labels; nulls are one label."""
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    sums = stored(sums, "codes-labels")
    same, columns = F.col("label").eqNullSafe(F.col("of_label")), [*coded.columns, "label_error"]
    if sums.count() <= _BROADCAST_LABELS:
        return coded.join(F.broadcast(sums), same).select(*columns)
    # Labels of over a thousandth of the rows are fewer than a thousand; the others spread by shuffle.
    limit = sums.agg(F.sum("n")).first()[0] // _HOT_LABELS
    hot, cold = F.broadcast(sums.where(F.col("n") > limit)), sums.where(F.col("n") <= limit)
    return coded.join(hot, same).select(*columns).unionByName(coded.join(hot, same, "left_anti").join(cold, same).select(*columns))


OUT = "vec_id {key}, code string, error bigint, label_error bigint, codebooks_sha256 string"


def compress(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS, owner_rows: int = OWNER_ROWS) -> DataFrame:
    """Key, code, error, label_error and codebooks_sha256 of every usable vector.

    Not usable, and left out: null vectors, those with null or non-finite components or one of 65,536
    or more in size, empty ones, and those whose length is no multiple of 16 or not that of the vector
    first in order of keys. Codebooks start from the 64 first vectors in that order, equal keys by their
    components, null keys last; fewer vectors give fewer entries, and equal ones equal entries, of which
    the lowest is used. Rows with repeated or null keys each have a code. Null labels are one label.
    Other columns are left out, so their names cannot clash; without usable vectors the result is empty.
    """
    spark, kind = vectors.sparkSession, vectors.schema[key].dataType.simpleString()
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    usable = vectors.where(_usable(F.col(vector))).select(F.col(key).alias("vec_id"), F.col(label).alias("label"), whole.alias("vector"))
    order = [F.col("vec_id").asc_nulls_last(), "vector"]
    first = usable.orderBy(*order).limit(1).collect()
    if not first:
        return spark.createDataFrame([], OUT.format(key=kind)).withColumnRenamed("vec_id", key)
    size = len(first[0]["vector"])
    kept = stored(usable.where(F.size("vector") == size).withColumn("row", F.monotonically_increasing_id()), "codes-vectors")
    seeds = [r["vector"] for r in kept.orderBy(*order).limit(ENTRIES).collect()]
    books = np.array(seeds, np.int64).reshape(len(seeds), PARTS, size // PARTS).transpose(1, 0, 2)

    rows = kept.count()
    salts = parts_for(rows, owner_rows)
    members, books = _settled(_owned(_first_members(kept, books), salts, rows * PARTS), books, rounds, salts, rows * PARTS)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = _compared(members, books).select("row", (F.col("nearest") * PARTS + F.col("position")).alias("place"), "error")
    codes = coded.groupBy("row").agg(
        F.sum("error").alias("error"), F.array_sort(F.collect_list(F.struct((F.col("place") % PARTS).alias("p"), F.floor(F.col("place") / PARTS).alias("e")))).alias("at")
    )
    digits = F.array_join(F.transform("at", lambda x: F.lpad(F.lower(F.hex(x["e"])), 2, "0")), "")
    whole_rows = stored(kept.select("row", "vec_id", "label").join(codes.select("row", digits.alias("code"), "error"), "row"), "codes-rows")
    return _label_errors(whole_rows).select(F.col("vec_id").alias(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


def _round_sql(before: str, after: str) -> str:
    """One assignment and update; entries without members stay."""
    return f"""
{after}_near AS ({_nearest_sql(before)}),
{after}_mean AS (SELECT j, e, list(m ORDER BY i) AS c FROM (
    SELECT j, e, i, floor(sum(p[i]) / count(*)) AS m FROM {after}_near, size, range(1, size.d + 1) t(i) GROUP BY j, e, i) GROUP BY j, e),
{after} AS (SELECT b.j, b.e, coalesce(u.c, b.c) AS c FROM {before} b LEFT JOIN {after}_mean u USING (j, e))"""


def _nearest_sql(books: str) -> str:
    distance = "list_inner_product(p, p) - 2 * list_inner_product(p, c) + list_inner_product(c, c)"
    best = f"min(({distance})::BIGINT * {ENTRIES} + e)"
    return f"""SELECT vec_id, label, j, any_value(p) AS p, best % {ENTRIES} AS e, best // {ENTRIES} AS distance FROM (
    SELECT vec_id, label, j, any_value(p) AS p, {best} AS best FROM parts JOIN {books} USING (j) GROUP BY vec_id, label, j) GROUP BY ALL"""


ORACLE_SQL = f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
size AS (SELECT max(len(v)) // {PARTS} AS d FROM kept),
parts AS (SELECT vec_id, label, j, v[j * d + 1 : j * d + d] AS p FROM kept, size, range({PARTS}) t(j)),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {ENTRIES}),
book0 AS (SELECT j, e, p AS c FROM parts JOIN seeds USING (vec_id)),
{reduce(lambda sql, i: f"{sql},{_round_sql(f'book{i}', f'book{i + 1}')}" if sql else _round_sql(f"book{i}", f"book{i + 1}"), range(ROUNDS), "")},
final AS ({_nearest_sql(f"book{ROUNDS}")}),
coded AS (SELECT vec_id, label, string_agg(format('{{:02x}}', e::BIGINT), '' ORDER BY j) AS code, sum(distance)::BIGINT AS error FROM final GROUP BY vec_id, label),
digest AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT::VARCHAR), ','), ',' ORDER BY j, e)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, digest
"""
