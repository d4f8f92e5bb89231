"""WARC: writer, gzip normaliser with a sidecar index, and indexed reader.

``write_archives`` writes records with Spark's text writer: one gzip stream
per file over all its records, which a reader can only inflate from the
start.  ``normalise`` inflates each such file once, front to back, rewrites
every record as a gzip member of its own and writes beside it a sidecar with
offset and length of every member.  ``read_archives`` reads single members at
those offsets, so an archive is split among tasks.

Archives are streamed in chunks: memory is a chunk plus one record, whatever
the archive's size.  A task that is run again writes the same bytes: each
output is written under a name of its attempt and then moved into place.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from .shared import file_system, stored

MIN_REVISIT_BYTES = 100
CHUNK = 1 << 20
LEVEL = 6  # of the members' compression
NEWLINE = "\r\n"
ID_FORM = "<urn:page:%s>"

INDEX_SCHEMA = "archive string, record long, offset long, length long, record_type string, record_id string, target_uri string"
RECORD_SCHEMA = (
    "archive string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
    "stated_digest string, payload binary"
)


def with_roles(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with payload facts and the record type.

    Of rows with equal payloads of at least 100 bytes, those with the smallest
    page_id are responses and the others revisits of it (a null page_id is
    never the smallest; rows that repeat the smallest page_id are all
    responses).  Null html is an empty payload.  The digests are counted with
    map-side combining, and the repeated ones written: the join back then has
    plain shuffles on both sides (a side that comes out of an aggregate cannot
    be split), so AQE splits it at a payload that a third of the rows share.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha2(F.encode(html, "UTF-8"), 256).alias("payload_digest"),
    )
    firsts = (
        base.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
        .select("payload_digest", "first_id")
    )
    firsts = stored(firsts, "warc-firsts")
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    return base.join(firsts, "payload_digest", "left").withColumn(
        "refers_to", F.when(revisit, F.col("first_id"))
    ).drop("first_id")


def _header(name: str, value: Column) -> Column:
    """One header line; line breaks in a value are percent-encoded, null is empty."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    text = F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(F.lit(f"{name}: "), text, F.lit(NEWLINE))


def _urn(page_id: Column) -> Column:
    return F.format_string(ID_FORM, F.coalesce(page_id.cast("string"), F.lit("")))


def record_text() -> Column:
    """The WARC record of a row of :func:`with_roles`, up to the ``\\n`` that the writer adds."""
    is_revisit = F.col("refers_to").isNotNull()
    http_head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{NEWLINE}Content-Type: text/html; charset=utf-8{NEWLINE}"),
        _header("Content-Length", F.col("payload_bytes")),
        F.lit(NEWLINE),
    )
    block = F.when(is_revisit, F.lit("")).otherwise(F.concat(http_head, F.col("html")))
    head = F.concat(
        F.lit(f"WARC/1.1{NEWLINE}"),
        _header("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", _urn(F.col("page_id"))),
        _header("WARC-Target-URI", F.col("url")),
        F.when(
            is_revisit,
            F.concat(
                _header("WARC-Refers-To", _urn(F.col("refers_to"))),
                _header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            ),
        ).otherwise(F.lit(f"Content-Type: application/http;msgtype=response{NEWLINE}")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _header("Content-Length", F.octet_length(block)),
        F.lit(NEWLINE),
    )
    return F.concat(head, block, F.lit("\r\n\r"))


def write_archives(pages: DataFrame, path: str | None = None) -> str:
    """Write one WARC record per page; each file is one gzip stream.  Returns the folder."""
    path = path or fresh_path(pages.sparkSession, "warc")
    records = with_roles(pages).select(record_text().alias("value"))
    records.write.option("compression", "gzip").option("lineSep", "\n").text(path)
    return path


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """(archive) of a folder's ``.gz`` files; no file is opened."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return listing.select(F.col("path").alias("archive"))


def _inflated(stream, size: int = CHUNK) -> Iterator[bytes]:
    """Inflate a gzip file of one or many members, chunk by chunk."""
    inflater, fresh = zlib.decompressobj(31), True
    while data := stream.read(size):
        while data:
            out = inflater.decompress(data, size)
            fresh = False
            if out:
                yield out
            data = inflater.unconsumed_tail
            if inflater.eof:
                data = inflater.unused_data
                inflater, fresh = zlib.decompressobj(31), True
    while not fresh and (out := inflater.decompress(b"", size)):  # output that waited for room
        yield out
    if not fresh and not inflater.eof:
        raise ValueError("the gzip stream ends inside a member")


def parse_head(head: bytes) -> dict[str, str]:
    """Lower-cased header names to values (the first line under ``""``)."""
    lines = head.decode("utf-8", "replace").split(NEWLINE)
    found = {"": lines[0]}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        found.setdefault(name.strip().lower(), value.strip())
    return found


def split_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of every record of an inflated archive, one at a time."""
    buffer = bytearray()

    def more() -> bool:
        chunk = next(chunks, None)
        if chunk is None:
            return False
        buffer.extend(chunk)
        return True

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not more():
                if buffer.strip():
                    raise ValueError("the archive ends inside a record's header")
                return
        head = parse_head(bytes(buffer[:end]))
        if not head[""].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {head['']!r}")
        whole = end + 4 + int(head["content-length"]) + 4
        while len(buffer) < whole:
            if not more():
                raise ValueError("the archive ends inside a record")
        yield head, bytes(buffer[:whole])
        del buffer[:whole]


def _normalise_one(archive: str, out: str) -> None:
    source, source_path = file_system(archive)
    target, target_path = file_system(out)
    base = f"{target_path}/{archive.rsplit('/', 1)[-1]}"
    attempt = f"{target_path}/_attempt-{uuid.uuid4().hex}"
    offset = 0
    with (
        source.open_input_stream(source_path, compression=None) as stream,
        target.open_output_stream(f"{attempt}.gz", compression=None) as members,
        target.open_output_stream(f"{attempt}.idx", compression=None) as index,
    ):
        for number, (head, record) in enumerate(split_records(_inflated(stream))):
            deflater = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            member = deflater.compress(record) + deflater.flush()
            members.write(member)
            entry = {
                "archive": f"{out}/{base.rsplit('/', 1)[-1]}",
                "record": number,
                "offset": offset,
                "length": len(member),
                "record_type": head.get("warc-type", ""),
                "record_id": head.get("warc-record-id", ""),
                "target_uri": head.get("warc-target-uri", ""),
            }
            index.write(json.dumps(entry).encode() + b"\n")
            offset += len(member)
    for suffix, name in ((".gz", base), (".idx", f"{base}.idx")):
        try:
            target.move(attempt + suffix, name)
        except OSError:  # an earlier attempt's file is there, and this file system does not replace it
            target.delete_file(name)
            target.move(attempt + suffix, name)


def normalise(spark: SparkSession, path: str, out: str | None = None) -> str:
    """Rewrite every archive of ``path`` with a member per record and a sidecar ``.idx``.

    Returns the output folder.  Any gzip layout is read (one stream, many
    members).  One archive is one task, since its stream can only be inflated
    from the start.
    """
    out = out or fresh_path(spark, "warc-members")
    target, target_path = file_system(out)
    target.create_dir(target_path, recursive=True)
    archives = list_archives(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                _normalise_one(archive, out)
                yield pa.RecordBatch.from_pydict({"archive": [archive]})

    done = archives.repartition(max(1, archives.count())).mapInArrow(run, "archive string")
    done.agg(F.count(F.lit(1))).collect()  # runs the tasks; a number comes back
    return out


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The sidecar indexes of a normalised folder as one table."""
    return spark.read.schema(INDEX_SCHEMA).option("pathGlobFilter", "*.idx").json(path)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """(WARC headers, payload): of an HTTP response, what follows the HTTP header."""
    end = record.index(b"\r\n\r\n")
    head = parse_head(record[:end])
    block = record[end + 4 : end + 4 + int(head["content-length"])]
    if head.get("content-type", "").startswith("application/http"):
        block = block[block.index(b"\r\n\r\n") + 4 :]
    return head, block


def read_archives(index: DataFrame) -> DataFrame:
    """The records that ``index`` rows point at; each is read at its offset alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle, opened = None, None
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for archive, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if opened != archive:
                    files, name = file_system(archive)
                    handle, opened = files.open_input_file(name), archive
                handle.seek(offset)
                head, payload = parse_record(zlib.decompress(handle.read(length), 31))
                digest = head.get("warc-payload-digest", "").removeprefix("sha256:")
                rows.append(
                    (archive, offset, head.get("warc-type"), head.get("warc-record-id"), head.get("warc-target-uri"),
                     head.get("warc-refers-to"), digest, payload)
                )
                size += len(payload)
                if size > 8 * CHUNK:
                    yield _record_batch(rows)
                    rows, size = [], 0
            if rows:
                yield _record_batch(rows)

    return index.select("archive", "offset", "length").mapInArrow(run, RECORD_SCHEMA)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]
    names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def page_number(urn: Column) -> Column:
    """The page_id of a record id (null if it is empty)."""
    number = F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1)
    return F.when(number != "", number.cast("long"))


def page_records(pages: DataFrame) -> DataFrame:
    """Write, normalise and read back: per page its record and the facts of its full payload.

    A revisit holds no payload; its length and digest are those of the
    response it refers to, by a join of revisits with responses.  Returns
    (page_id, payload_bytes, payload_digest, record_type, refers_to,
    target_uri), one row for each input row.
    """
    spark = pages.sparkSession
    members = normalise(spark, write_archives(pages))
    records = read_archives(read_index(spark, members)).select(
        page_number(F.col("record_id")).alias("page_id"),
        F.col("record_type"),
        page_number(F.col("refers_to")).alias("refers_to"),
        F.octet_length("payload").cast("long").alias("read_bytes"),
        F.sha2(F.col("payload"), 256).alias("read_digest"),
        "stated_digest",
        "target_uri",
    )
    facts = stored(records, "warc-facts")  # without payloads: the archives are read once
    responses = (
        facts.where(F.col("record_type") == "response")
        .groupBy(F.col("page_id").alias("refers_to"), F.col("read_digest").alias("stated_digest"))
        .agg(F.max("read_bytes").alias("full_bytes"))
    )
    responses = stored(responses, "warc-responses")  # for the join, as in with_roles
    own = F.col("record_type") == "response"
    return facts.join(responses, ["refers_to", "stated_digest"], "left").select(
        "page_id",
        F.when(own, F.col("read_bytes")).otherwise(F.col("full_bytes")).alias("payload_bytes"),
        F.when(own, F.col("read_digest")).when(F.col("full_bytes").isNotNull(), F.col("stated_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
        "target_uri",
    )

