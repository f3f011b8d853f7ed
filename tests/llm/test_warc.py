import hashlib
import uuid

from assaysift.llm import warc


def round_trip(spark, rows, tmp_path, schema="page_id long, url string, html string", **options):
    path = str(tmp_path / uuid.uuid4().hex)
    warc.write_archives(warc.decided(spark.createDataFrame(rows, schema).repartition(2)), path, **options)
    return warc.read_archives(spark, path)


def expected(rows):
    first = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 100:
            first[html] = min(page, first.get(html, page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        original = first.get(html) if page is not None and len(data) >= 100 and page != first[html] else None
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if original is not None else "response", original))
    return sorted(out, key=str)


def got(df):
    number = lambda x: None if x is None else int(x)
    return sorted(((number(r.key), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers)) for r in df.collect()), key=str)


def test_odd_payloads(spark, tmp_path):
    inner = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:99>\r\nContent-Length: 5\r\n\r\nHTTP\n\r\n\r\n"
    long = "é" * 60
    rows = [
        (1, "u", long), (2, None, long), (3, "u\r\nX: y", long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""),
        (8, "u", inner), (9, "u", "a" + inner * 3 + "b"), (10, "u", inner * 20), (11, "u", "WARC/1.0\r\n"), (12, "u", "x\r\n\r\nWARC/1.0\r\n\r\n"),
        (13, "u", "\r\n\r\n" * 40), (14, "u", "Content-Length: 3\r\n\r\n" + "z" * 200), (None, "u", long), (5, "u", "short"), (1, "u", long),
        (15, "u", "WARC/1.0\r\nContent-Length: 99999999999999999999\r\n\r\n"), (16, "u", inner * 20),
    ]
    assert got(round_trip(spark, rows, tmp_path)) == expected(rows)


def test_small_splits_and_many_links(spark, tmp_path):
    inner = "WARC/1.0\r\nContent-Length: 7\r\n\r\n" + "q" * 50
    rows = [(i, f"u{i}", f"<p>{i % 7}</p>" * 30 + inner * (i % 3)) for i in range(200)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert got(round_trip(spark, rows, tmp_path, records_per_file=60)) == expected(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_empty_table_and_clashing_columns(spark, tmp_path):
    schema = "page_id long, url string, html string, key string, payload string, original long"
    df = spark.createDataFrame([(1, "u", "h", "k", "p", 9)], schema)
    for rows, n in ((df, 1), (df.limit(0), 0)):
        path = str(tmp_path / uuid.uuid4().hex)
        warc.write_archives(warc.decided(rows), path)
        assert warc.read_archives(spark, path).count() == n
