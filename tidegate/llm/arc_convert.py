"""ARC archives to WARC: parse the legacy headers, synthesise the new ones.

An ARC file starts with a version block whose second line tells the version and whose
third names the fields of every record's header line; records follow by declared length.
The converter makes WARC records of them, with deterministic ids, timestamps, types and
digests, and turns equal payloads into revisits of one response. Archives are read as
whole files through Spark and parsed as a stream inside the task; they are written by
Spark's own writer, one file per task, so a lost executor repeats its files only.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegate.llm.common import prepare
from tidegate.session import materialize, run_dir

#: The header fields of the two ARC versions, and WARC's names.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
#: Bytes of parsed payloads that a task holds before it hands them on.
HELD = 8 << 20


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


class Inflating(io.RawIOBase):
    """The plain bytes of an archive: as they are, or of any number of gzip members."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at, self.packed = memoryview(data), 0, data[:2] == b"\x1f\x8b"
        self.inflater = zlib.decompressobj(31) if self.packed else None

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        if not self.packed:
            part = self.data[self.at : self.at + len(target)]
            self.at += len(part)
        else:
            part = b""
            while not part:
                if self.inflater.eof:
                    self.at -= len(self.inflater.unused_data)
                    if self.at >= len(self.data):
                        break
                    self.inflater = zlib.decompressobj(31)
                pending = self.inflater.unconsumed_tail
                if not pending:
                    pending = self.data[self.at : self.at + (1 << 16)]
                    self.at += len(pending)
                if not pending:
                    raise ValueError("archive ends inside a gzip member")
                part = self.inflater.decompress(pending, len(target))
        target[: len(part)] = part
        return len(part)


def opened(content: bytes) -> io.BufferedReader:
    return io.BufferedReader(Inflating(content), 1 << 16)


def iso_date(stamp: str) -> str:
    """14 digits, or the first 12, 10, 8 of them, as WARC writes times."""
    digits = re.sub(r"\D", "", stamp)[:14]
    digits += "19700101000000"[len(digits) :]
    d = digits
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header with its closing blank line, and the payload behind it."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = re.search(rb"\r?\n\r?\n", block)
    return (block[: end.end()], block[end.end() :]) if end else (block, b"")


def arc_records(content: bytes):
    """(fields, version, block) of each record behind the version block.

    Header fields are taken by the names the file declares; a url with blanks in it stays
    whole, as the other fields are counted from the end. A file that ends inside a record
    raises.
    """
    stream = opened(content)
    line = stream.readline()
    if not line:
        return
    length = int(line.split()[-1])
    block = stream.read(length)
    lines = block.decode("utf-8", "replace").split("\n")
    version = int(lines[0].split()[0])
    names = lines[1].split() if len(lines) > 1 and lines[1].strip() else ARC_FIELDS[version].split()
    while True:
        line = stream.readline()
        while line in (b"\n", b"\r\n"):
            line = stream.readline()
        if not line:
            return
        values = line.rstrip(b"\r\n").decode("utf-8", "replace").rsplit(" ", len(names) - 1)
        fields = dict(zip(names, values))
        size = int(fields["Archive-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"archive ends inside the record of {fields.get('URL')}")
        yield fields, version, block


def warc_records(content: bytes):
    """(headers, block) of each WARC record; header names are lower-cased."""
    stream = opened(content)
    while True:
        line = stream.readline()
        while line in (b"\n", b"\r\n"):
            line = stream.readline()
        if not line:
            return
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"archive ends inside {headers.get('warc-record-id')}")
        yield headers, block


def parsed(files: DataFrame, records, schema: str) -> DataFrame:
    """Rows that records(path, content) yields as tuples, in batches of bounded bytes."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows, held = [], 0
                for row in records(path.as_py(), content.as_py()):
                    rows.append(row)
                    held += sum(len(v) for v in row if isinstance(v, bytes)) + 500
                    if held > HELD:
                        yield packed(rows, arrow)
                        rows, held = [], 0
                if rows:
                    yield packed(rows, arrow)

    def packed(rows, arrow):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return files.mapInArrow(run, schema)


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select("path", "content")


RECORD = (
    "record_id string, warc_date string, url string, ip string, content_type string, payload_digest string, "
    "payload_bytes long, page_id long"
)


def arc_frame(spark: SparkSession, folder: str, payloads: bool) -> DataFrame:
    """The records of the ARC files of a folder, with their blocks if payloads is set."""

    def records(path, content):
        name = path.rsplit("/", 1)[-1]
        for n, (fields, version, block) in enumerate(arc_records(content)):
            head, payload = split_http(block)
            page = re.search(rb"(?im)^X-Page-Id: *(-?\d+)", head)
            url = fields["URL"]
            record_id = f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{name}#{n}#{url}')}>"
            row = (
                record_id, iso_date(fields["Archive-date"]), url, fields["IP-address"],
                "application/http; msgtype=response" if head else fields["Content-type"],
                base32_sha1(payload), len(payload), int(page[1]) if page else None,
            )
            if payloads:
                row += (head, payload, base32_sha1(block), base32_sha1(head))
            yield row

    more = ", head binary, payload binary, block_digest string, head_digest string" if payloads else ""
    return parsed(archive_files(spark, folder), records, RECORD + more)


def first_of_file() -> Column:
    """True for the first row of each task, which starts its file."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0


def written(lines: DataFrame, folder: str) -> None:
    """Write the column value as gzip files of its exact bytes; each value ends in what
    stands before a line feed, which the writer adds."""
    lines.select(F.col("value").cast("string")).write.option("compression", "gzip").text(folder)


def write_arc(pages: DataFrame, folder: str) -> None:
    """A folder of ARC files with one HTTP response per row of pages (page_id, url, html).

    Even ids are written by version 2, odd and null ones by version 1, each in files of
    their own.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.coalesce(F.nullif(F.regexp_replace("url", r"[\r\n]", ""), F.lit("")), F.lit("urn:page:none"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.coalesce(F.concat(F.lit("X-Page-Id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("")),
        F.lit("Content-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"),
    )
    block = F.concat(head, html)
    size = F.octet_length(block).cast("string")
    day = F.lit("20240102030405")
    is_two = F.coalesce(F.col("page_id") % 2 == 0, F.lit(False))
    for version, chosen in ((1, ~is_two), (2, is_two)):
        middle = [F.lit("127.0.0.1"), day, F.lit("text/html")]
        if version == 2:
            middle += [F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("pages.arc")]
        line = F.concat_ws(" ", url, *middle, size)
        declared = f"{version} 0 spark\n{ARC_FIELDS[version]}\n"
        tail = "" if version == 1 else " 200 - - 0 pages.arc"
        opening = f"filedesc://pages.arc 0.0.0.0 20240102030405 text/plain{tail} {len(declared)}\n{declared}\n"
        rows = pages.where(chosen).select(F.concat(line, F.lit("\n"), block).alias("record"))
        start = F.when(first_of_file(), F.lit(opening)).otherwise(F.lit(""))
        written(rows.select(F.concat(start, "record").alias("value")), f"{folder}/v{version}")


def convert_arc(spark: SparkSession, arc_folders: list[str], warc_folder: str) -> None:
    """WARC files of the ARC files in the folders.

    Of records with equal payloads the one with the largest page_id (of equal ids, the
    largest record id) stays a response (a resource if it has no HTTP header); the others
    become revisits without payload. Payloads cross one exchange, keyed by record, so
    equal ones need not meet in a task; which stays is decided on digests.
    """
    narrow = union_of([arc_frame(spark, f, False) for f in arc_folders])
    narrow = materialize(spark, narrow.select("record_id", "payload_digest", "page_id", "url", "warc_date"), "arc-records")
    order = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("p"), "record_id")
    keeper = narrow.groupBy("payload_digest").agg(
        F.max_by(F.struct("record_id", "url", "warc_date"), order).alias("first"), F.count("*").alias("n")
    ).where("n > 1").select("payload_digest", "first")
    others = narrow.join(keeper, "payload_digest").where("record_id <> first.record_id").select("record_id", "first")
    wide = union_of([arc_frame(spark, f, True) for f in arc_folders]).join(others, "record_id", "left")
    revisit = F.col("first").isNotNull()
    body = F.when(revisit, F.col("head")).otherwise(F.concat("head", "payload"))
    kind = F.when(revisit, "revisit").when(F.length("head") > 0, "response").otherwise("resource")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    headers = F.concat(
        F.lit("WARC/1.0\r\n"), line("WARC-Type", kind), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("warc_date")), line("WARC-Target-URI", F.col("url")),
        line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.when(revisit, F.col("head_digest")).otherwise(F.col("block_digest")))),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", F.col("first.record_id")),
            line("WARC-Refers-To-Target-URI", F.col("first.url")), line("WARC-Refers-To-Date", F.col("first.warc_date")),
        )).otherwise(F.lit("")),
        line("Content-Type", F.col("content_type")), line("Content-Length", F.length(body).cast("string")),
        F.lit("\r\n"),
    )
    about = "software: tidegate\r\nformat: WARC File Format 1.0\r\nconverted-from: ARC\r\n"
    opening = (
        "WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{}>\r\nWARC-Date: 2024-01-02T03:04:05Z\r\n"
        f"Content-Type: application/warc-fields\r\nContent-Length: {len(about)}\r\n\r\n{about}\r\n\r\n"
    ).format(uuid.uuid5(NAMESPACE, "warcinfo"))
    record = F.concat(headers.cast("binary"), body, F.lit("\r\n\r").cast("binary"))
    start = F.when(first_of_file(), F.lit(opening)).otherwise(F.lit("")).cast("binary")
    written(wide.select(record.alias("record")).select(F.concat(start, "record").alias("value")), warc_folder)


def union_of(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """record_id, record_type, payload_digest (as measured, or declared by a revisit),
    payload_bytes, refers_to_id, page_id of the records of a folder of WARC files. A
    payload or block that differs from its declared digest raises."""

    def records(path, content):
        for headers, block in warc_records(content):
            kind = headers["warc-type"]
            if kind == "warcinfo":
                continue
            head, payload = split_http(block)
            declared = headers["warc-payload-digest"].removeprefix("sha1:")
            if headers["warc-block-digest"] != "sha1:" + base32_sha1(block) or (
                kind != "revisit" and declared != base32_sha1(payload)
            ):
                raise ValueError(f"digest differs in {headers['warc-record-id']}")
            page = re.search(rb"(?im)^X-Page-Id: *(-?\d+)", head)
            yield (
                headers["warc-record-id"], kind, declared, None if kind == "revisit" else len(payload),
                headers.get("warc-refers-to"), int(page[1]) if page else None, headers.get("warc-target-uri"),
            )

    return parsed(
        archive_files(spark, folder), records,
        "record_id string, record_type string, payload_digest string, payload_bytes long, refers_to_id string, "
        "page_id long, url string",
    )


def pages_through_archives(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write pages as ARC, convert to WARC, read back: page_id, payload_bytes,
    payload_digest, record_type, refers_to (page of the response).

    Null html is an empty payload, equal to every other empty one. Null urls and ids, ids
    that come twice and other columns do no harm; each row is a record.
    """
    prepare(spark)
    folder = run_dir(spark, "archives")
    write_arc(pages, f"{folder}/arc")
    convert_arc(spark, [f"{folder}/arc/v1", f"{folder}/arc/v2"], f"{folder}/warc")
    back = materialize(spark, read_warc(spark, f"{folder}/warc"), "archive-index")
    target = back.where("record_type <> 'revisit'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("target_bytes"),
    )
    # One response may be the target of a third of all rows; the rows are narrow, and the
    # join's side with the skew is split by adaptive execution.
    return back.join(target, "refers_to_id", "left").select(
        "page_id", F.coalesce("payload_bytes", "target_bytes").alias("payload_bytes"), "payload_digest",
        "record_type", "refers_to",
    )


#: What pages_through_archives must return, in DuckDB's SQL.
ORACLE_SQL = """
WITH d AS (
  SELECT page_id, coalesce(html, '') AS body, CAST(CAST(from_hex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS bits
  FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS kept FROM d)
SELECT page_id, strlen(body) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + 16 * CAST(substr(bits, 5 * k + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * k + 2, 1) AS INT)
           + 4 * CAST(substr(bits, 5 * k + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * k + 4, 1) AS INT)
           + CAST(substr(bits, 5 * k + 5, 1) AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM m
"""
