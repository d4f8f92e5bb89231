import gzip
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from tripstats.llm import queries, warc

SCHEMA = "page_id long, url string, html string, payload_digest string, refers_to string"


def pages_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def brute(rows):
    out = []
    payloads = [(p, (h or "").encode()) for p, _, h in rows]
    for p, body in payloads:
        same = [q for q, other in payloads if other == body and q is not None] if len(body) >= 100 else []
        first = min(same, default=None)
        refers = first if first is not None and first != p else None
        out.append((p, len(body), hashlib.sha256(body).hexdigest(), "response" if refers is None else "revisit", refers))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


BIG = "<p>é\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\n" + "x" * 200
ROWS = [
    (5, "http://a/", BIG),
    (3, "http://b/\r\nWARC-Type: evil", BIG),
    (9, None, BIG),
    (9, None, BIG),
    (3, "http://twice/", BIG),
    (1, "http://c/", None),
    (2, "", ""),
    (4, "http://d/", "short"),
    (6, "http://e/", "short"),
    (None, "http://f/", BIG),
    (None, "http://g/", "only here " * 20),
    (7, "http://h/", "long " * 400_000),
    (8, "http://i/", "\r\n\r\n" * 50),
]


def test_page_records_match_brute_force(spark):
    found = warc.page_records(pages_frame(spark, ROWS).repartition(3))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in found.select(names).collect()), key=key) == sorted(brute(ROWS), key=key)


def test_no_pages(spark):
    assert warc.page_records(pages_frame(spark, [])).count() == 0


def test_query_is_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.001/pages.parquet'")
    cur = con.execute(queries.oracle_sql()["op1_warc"])
    names = [d[0] for d in cur.description]
    found = queries.op1_warc(spark, "/root/testdata/sf0.001").select(names).collect()
    assert sorted(map(tuple, found), key=key) == sorted(cur.fetchall(), key=key)


def test_monolithic_archive_becomes_a_member_for_each_record(spark, tmp_path):
    source = warc.write_archives(pages_frame(spark, ROWS).coalesce(1), str(tmp_path / "mono"))
    archives = [r.archive for r in warc.list_archives(spark, source).collect()]
    assert len(archives) == 1
    data = open(archives[0].removeprefix("file:"), "rb").read()
    first = zlib.decompressobj(31)
    first.decompress(data)
    assert first.eof and not first.unused_data  # one stream over all records
    out = warc.normalise(spark, source, str(tmp_path / "members"))
    index = warc.read_index(spark, out).orderBy("offset").collect()
    assert len(index) == len(ROWS)
    made = open(index[0].archive.removeprefix("file:"), "rb").read()
    assert gzip.decompress(made) == gzip.decompress(data)  # the same bytes
    at = 0
    for row in index:
        assert row.offset == at
        member = zlib.decompressobj(31)
        record = member.decompress(made[at : at + row.length])
        assert member.eof and not member.unused_data and record.startswith(b"WARC/1.1\r\n")
        at += row.length
    assert at == len(made)
    again = warc.normalise(spark, out, str(tmp_path / "again"))  # many members are read as well
    assert warc.read_index(spark, again).count() == len(ROWS)


def test_chunks_do_not_matter():
    records = [b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (n, b"z" * n) for n in (0, 1, 50, 3000)]
    data = gzip.compress(b"".join(records))
    many = b"".join(map(gzip.compress, records))
    for blob in (data, many):
        for size in (1, 7, 64, 1 << 20):
            assert [r for _, r in warc.split_records(warc._inflated(io.BytesIO(blob), size))] == records


def test_broken_archives_are_refused():
    record = b"WARC/1.1\r\nContent-Length: 10\r\n\r\n0123456789\r\n\r\n"
    for blob in (gzip.compress(record)[:-9], gzip.compress(record[:-8]), gzip.compress(b"HTTP/1.1 200\r\n\r\n")):
        with pytest.raises(ValueError):
            list(warc.split_records(warc._inflated(io.BytesIO(blob))))


def test_urls_cannot_add_header_lines(spark):
    text = warc.with_roles(pages_frame(spark, ROWS)).where("page_id = 3").select(warc.record_text().alias("r")).first().r
    assert "\r\nWARC-Type: evil" not in text.split("\r\n\r\n")[0]


def test_roles_use_a_grouped_count(spark):
    plan = warc.with_roles(pages_frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and F is not None


def test_file_systems_and_repeated_attempts(spark, tmp_path):
    from tripstats.llm.shared import file_system

    for uri in ("/a/b", "file:/a/b", "file:///a/b"):
        assert file_system(uri)[1] == "/a/b"
    source = warc.write_archives(pages_frame(spark, ROWS).coalesce(1), str(tmp_path / "mono"))
    archive = warc.list_archives(spark, source).first().archive
    out = tmp_path / "members"
    out.mkdir()
    made = []
    for _ in range(2):  # a task that runs again
        warc._normalise_one(archive, f"file:{out}")
        made.append({p.name: p.read_bytes() for p in out.iterdir()})
    assert made[0] == made[1] and len(made[0]) == 2


def test_hot_payload_is_split(spark):
    """Half of the rows share a payload: without broadcasts, AQE splits the join at it."""
    html = "'<html>' || repeat('same ', 60)"
    pages = spark.range(20_000).selectExpr("id AS page_id", "'u' AS url", f"IF(id % 2 = 0, {html}, {html} || id) AS html").repartition(8)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        roles = warc.with_roles(pages)
        revisits = roles.collect()
        assert sum(r.refers_to == 0 for r in revisits) == 9_999 and len(revisits) == 20_000
        assert "skew=true" in roles._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
