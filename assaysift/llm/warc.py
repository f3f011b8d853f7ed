"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

Writing: a record is one text row, and the writer's line separator is the blank line that ends a record,
so archives go through Spark's own commit protocol to any file system. Of equal payloads one is a
response and the others revisit it; only keys and digests are grouped, never payloads.

Reading: Spark's text reader splits archives at the magic line, in parallel inside a file too. Each
piece is a candidate record, and its header gives the offset of its successor. A candidate counts only
if the chain of successors from the file's start reaches it, so magic inside payloads is rejected.
Stretches of candidates that follow one another are one link of the chain, and pointer jumping over
links marks the reachable ones in a number of joins that grows with the logarithm of the links.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from assaysift.sources.scratch import scratch_folder

from .common import stored, table

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
MIN_REVISIT = 100  #: bytes; smaller payloads are always responses
BROADCAST_ROWS = 100_000  #: revisit decisions, about 150 bytes each, up to which they are broadcast
DATE = "2024-01-01T00:00:00Z"
_URN = "urn:x-page:"


def decided(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = MIN_REVISIT) -> DataFrame:
    """key, url, payload, payload_bytes, payload_digest and ``original``, the key a revisit refers to (else null).

    A null payload is empty. Of equal payloads of at least ``min_bytes``, the rows of the smallest key
    are responses (all of them, if that key repeats) and the others revisit it; a row with a null key
    can be neither referred to nor told apart, so it is always a response.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    light = rows.where(F.col("key").isNotNull() & (F.col("payload_bytes") >= min_bytes)).select("key", "payload_digest")
    first = light.groupBy("payload_digest").agg(F.min("key").alias("original"), F.max("key").alias("last")).where("original <> last")
    revisits = light.join(first.drop("last"), "payload_digest").where("key <> original").distinct()
    revisits = stored(revisits, "revisits")
    small = revisits.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(revisits) if small else revisits, ["key", "payload_digest"], "left")


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.coalesce(value if isinstance(value, Column) else F.lit(value), F.lit("")), F.lit("\r\n"))


def write_archives(rows: DataFrame, path: str, *, records_per_file: int = 50_000) -> None:
    """Write the rows of ``decided`` as WARC files under ``path``, without a shuffle."""
    revisit = F.col("original").isNotNull()
    urn = lambda c: F.concat(F.lit(f"<{_URN}"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), _line("Content-Type", "text/html; charset=utf-8"), _line("Content-Length", F.col("payload_bytes").cast("string")), F.lit("\r\n"))
    block = F.octet_length("http") + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    record = F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", urn("key")),
        F.when(revisit, F.concat(_line("WARC-Refers-To", urn("original")), _line("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))).otherwise(""),
        _line("WARC-Date", DATE),
        _line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]+", "%0A")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _line("Content-Type", "application/http; msgtype=response"),
        _line("Content-Length", block.cast("string")),
        F.lit("\r\n"),
        F.col("http"),
        F.when(revisit, "").otherwise(F.col("payload")),
    )
    out = rows.withColumn("http", http).select(record.alias("value"))
    out.write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


def _pieces(spark: SparkSession, path: str, with_value: bool) -> DataFrame:
    """Everything between two magic lines, with what its header says and its place in the file.

    A split's pieces are numbered in reading order; running sums of their sizes, on top of the sums of
    the splits before, are byte offsets. ``at`` is where a piece's own magic line begins.
    """
    raw = spark.read.option("lineSep", MAGIC).text(path)
    raw = raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("n"))
    raw = raw.withColumns({"size": F.octet_length("value").cast("long"), "head": F.substring_index("value", END, 1)})
    said = lambda name, value=r"(\S+)": F.regexp_extract("head", rf"(?mi)^{name}: *{value}", 1)
    raw = raw.withColumns(
        {
            "content": said("Content-Length", r"(\d{1,15})\r?$").try_cast("long"),
            "body": (F.octet_length("head") + 4).cast("long"),
            "http": (F.octet_length(F.substring_index("value", END, 2)) + 4).cast("long"),
        }
    )
    # a piece that ends where its record ends is digested at once, and its payload goes no further
    whole = F.col("body") + F.col("content") + 4 == F.col("size")
    data = F.substring(F.col("value").cast("binary"), F.col("http").cast("int") + 1, (F.col("body") + F.col("content") - F.col("http")).cast("int"))
    raw = raw.select(
        "file", "split", "n", "size", "body", "content", "http", F.coalesce(whole, F.lit(False)).alias("whole"),
        said("WARC-Type").alias("type"), said("WARC-Record-ID").alias("id"), said("WARC-Refers-To").alias("refers"),
        F.regexp_extract(said("WARC-Payload-Digest"), "sha256:([0-9a-f]+)", 1).alias("told_digest"),
        F.regexp_extract(F.substring_index("value", END, 2), r"(?i)\r\nContent-Length: *(\d{1,15})(?:\r\n[^\r\n]+)*$", 1).try_cast("long").alias("told_bytes"),
        F.when(whole, F.sha2(data, 256)).alias("digest"),
        *(["value"] if with_value else []),
    )
    length = F.col("size") + len(MAGIC)
    inside = W.partitionBy("file", "split").orderBy("n")
    before = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    splits = raw.groupBy("file", "split").agg(F.sum(length).alias("bytes"))
    splits = splits.select("file", "split", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    placed = raw.withColumn("upto", F.sum(length).over(inside)).join(splits, ["file", "split"])
    start = F.col("base") + F.col("upto") - length
    return placed.withColumn("at", start - len(MAGIC)).drop("base", "upto", "n")


def _reachable(candidates: DataFrame) -> DataFrame:
    """(file, at) of the records on the chain from each file's start; candidates hold file, split, at, next."""
    order = W.partitionBy("file", "split").orderBy("at")
    breaks = F.coalesce((F.lag("next").over(order) != F.col("at")).cast("int"), F.lit(1))
    # a new link begins wherever the candidate before does not lead here
    linked = candidates.withColumn("fresh", breaks).withColumn("run", F.sum("fresh").over(order))
    linked = linked.withColumn("link", F.min("at").over(W.partitionBy("file", "split", "run"))).select("file", "at", "next", "link")
    linked = stored(linked, "warc-links")
    ends = linked.groupBy("file", "link").agg(F.max_by("next", "at").alias("next"))
    entered = linked.select("file", F.col("at").alias("next"), F.col("link").alias("to"), F.col("at").alias("entry"))
    jump = stored(ends.join(entered, ["file", "next"]).select("file", "link", "to", "entry"), "warc-jumps")
    most = ends.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    reached = linked.where("at = 0").select("file", "link", F.col("at").alias("entry"))
    step = 1
    while step < most:  # after each round all links within ``step`` jumps are marked
        onward = jump.select("file", "link", F.col("to").alias("far"), F.col("entry").alias("far_entry"))
        more = reached.drop("entry").join(onward, ["file", "link"]).select("file", F.col("far").alias("link"), F.col("far_entry").alias("entry"))
        reached = stored(reached.unionByName(more).groupBy("file", "link").agg(F.min("entry").alias("entry")), "warc-reached")
        twice = onward.withColumnRenamed("link", "to").join(jump.drop("entry"), ["file", "to"])
        jump = stored(twice.select("file", "link", F.col("far").alias("to"), F.col("far_entry").alias("entry")), "warc-jumps")
        step *= 2
    return linked.join(reached, ["file", "link"]).where("at >= entry").select("file", "at")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: key (text), record_type, refers (text), payload_bytes, payload_digest, told_digest.

    Sizes and digests of responses are computed from the payload read; a revisit has none, so its HTTP
    header and ``WARC-Payload-Digest`` give them. Bytes that no chain reaches are no records.
    """
    pieces = _pieces(spark, path, False).withColumn("next", F.col("at") + len(MAGIC) + F.col("body") + F.col("content") + 4)
    pieces = stored(pieces, "warc-pieces")
    found = _reachable(pieces.where("at >= 0 and next is not null").select("file", "split", "at", "next"))
    records = stored(pieces.join(found, ["file", "at"]), "warc-records")
    parted = records.where("not whole")
    if parted.limit(1).count():
        # magic inside a payload: put the pieces from the record's start to its end together again
        inner = _pieces(spark, path, True).select("file", F.col("at").alias("piece"), "value")
        inner = inner.join(parted.select("file").distinct(), "file", "left_semi")
        owners = parted.select("file", "at", "next", "http", "body", "content")
        starts = W.partitionBy("file").orderBy("piece", F.col("value").isNull().desc())
        marked = inner.withColumn("at", F.lit(None).cast("long")).unionByName(
            records.join(parted.select("file").distinct(), "file", "left_semi").select("file", F.col("at").alias("piece"), F.lit(None).cast("string").alias("value"), "at")
        )
        owned = marked.withColumn("at", F.last("at", ignorenulls=True).over(starts)).where("value is not null")
        owned = owned.join(owners, ["file", "at"]).where(F.col("piece") < F.col("next"))
        joined = owned.groupBy("file", "at").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "value"))), lambda x: x["value"]), MAGIC).alias("text"),
            F.first("http").alias("http"), F.first("body").alias("body"), F.first("content").alias("content"),
        )
        data = F.substring(F.col("text").cast("binary"), F.col("http").cast("int") + 1, (F.col("body") + F.col("content") - F.col("http")).cast("int"))
        whole = joined.select("file", "at", F.sha2(data, 256).alias("joined_digest"))
        records = records.join(whole, ["file", "at"], "left").withColumn("digest", F.coalesce("digest", "joined_digest"))
    key = lambda c: F.nullif(F.regexp_extract(c, f"^<{_URN}(.*)>$", 1), F.lit(""))
    response = F.col("type") == "response"
    return records.select(
        key("id").alias("key"),
        F.col("type").alias("record_type"),
        key("refers").alias("refers"),
        F.when(response, F.col("body") + F.col("content") - F.col("http")).otherwise(F.col("told_bytes")).alias("payload_bytes"),
        F.when(response, F.col("digest")).otherwise(F.col("told_digest")).alias("payload_digest"),
        "told_digest",
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(decided(table(spark, sf_dir, "pages")), path)
    back = read_archives(spark, path)
    return back.select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers").cast("long").alias("refers_to")
    )


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS o FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
    CASE WHEN n >= 100 AND page_id <> o THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND page_id <> o THEN o END AS refers_to
FROM p LEFT JOIN f USING (d)
"""
