"""Operator 1: legacy ARC archives converted to WARC.

ARC files begin with a version block that names the fields of every record header line
(version 1 has five, version 2 ten); each record's body has the length declared at the
end of its line.  The converter reads header lines by that definition, takes bodies by
declared length alone, parts HTTP head and payload, and makes the equivalent WARC
records: identifiers by name-based UUID, timestamps from the 14-digit date, the record
type, block and payload digests.  A payload of at least ``min_bytes`` that occurs more
than once is kept in the record with the smallest key; the others become revisits.

Archives are rows (name, content) of bounded size, so they can come from
``read_archives`` over a folder or from another operator.  ``write_archives`` writes
one gzip file per row through Spark's own writer, ``read_archives`` reads files through
Spark's own reader: any store that Spark reaches will do.

Defined results: a null payload is an empty one; a null URL is written as
``urn:none:``; white space and control characters in a URL are percent-encoded; a
record with a null key is always a response; rows that repeat the smallest key with an
equal payload are all responses; a record cut off before its declared length keeps what
is there and is marked truncated; bytes after the last record that are no header line
raise an error; an empty table gives no records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qmeasures.llm.common import as_bytes, bound_batches, materialize

ARCHIVE_BYTES = 8 << 20
FIELDS = {  # fixed values: the record header definitions of the two ARC versions
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = ("archive string, offset long, version int, url string, ip string, date string, mime string, "
           "head binary, payload binary, truncated boolean")
_UNSAFE = re.compile(rb"[\x00-\x20\x7f]")


# --- ARC -----------------------------------------------------------------------------


def version_block(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 converter\n{FIELDS[version]}\n".encode()
    first = [f"filedesc://{name}", "0.0.0.0", date, "text/plain"]
    if version == 2:
        first += ["200", "-", "-", "0", name]
    return " ".join([*first, str(len(body))]).encode() + b"\n" + body + b"\n"


def arc_record(version: int, url: bytes | None, ip: str, date: str, mime: str, body: bytes, offset: int, name: str) -> bytes:
    target = _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], url) if url else b"urn:none:"
    line = [target, ip.encode(), date.encode(), mime.encode()]
    if version == 2:
        line += [b"200", hashlib.md5(body).hexdigest().encode(), b"-", str(offset).encode(), name.encode()]
    return b" ".join([*line, str(len(body)).encode()]) + b"\n" + body + b"\n"


def arc_archives(pages: DataFrame, key: str, url: str, payload: str, date: str = "20010203040506",
                 size: int = ARCHIVE_BYTES) -> DataFrame:
    """Lay rows out as ARC archives (name, content) of about ``size`` bytes, versions taking turns.

    The key travels in the HTTP head as X-Page-Id.
    """
    bound_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, turn, kept, held = None, 0, [], 0

        def start() -> None:
            nonlocal kept, held
            kept = [version_block(f"{part}-{turn}.arc", 1 + turn % 2, date)]
            held = len(kept[0])

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"{part}-{turn}.arc"]), pa.array([b"".join(kept)], pa.binary())],
                                              names=["archive", "content"])
        for batch in batches:
            for k, u, body, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2)),
                                     batch.column(3).to_pylist()):
                if part is None:
                    part = p
                    start()
                mark = b"" if k is None else b"X-Page-Id: %d\r\n" % k
                doc = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n%bContent-Length: %d\r\n\r\n%b" % (
                    mark, len(body), body)
                kept.append(arc_record(1 + turn % 2, None if u is None else u.encode(), "0.0.0.0", date, "text/html", doc,
                                       held, f"{part}-{turn}.arc"))
                held += len(kept[-1])
                if held >= size:
                    yield archive()
                    turn += 1
                    start()
        if len(kept) > 1:
            yield archive()

    return pages.select(F.col(key).cast("long"), F.col(url).cast("string"), F.col(payload).cast("string"),
                        F.spark_partition_id()).mapInArrow(run, "archive string, content binary")


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """HTTP head with its blank line, and payload; no head if the body isn't HTTP."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    ends = [(at, len(mark)) for mark in (b"\r\n\r\n", b"\n\n") if (at := body.find(mark)) >= 0]
    if not ends:
        return body, b""
    at, width = min(ends)
    return body[:at + width], body[at + width:]


def arc_records(content: bytes) -> Iterator[dict]:
    """Records of one ARC archive in order, the version block left out."""
    at, names, version = 0, FIELDS[1].split(), 1
    while at < len(content):
        if content[at] in b"\r\n":  # blank lines between records
            at += 1
            continue
        end = content.find(b"\n", at)
        line = content[at:end if end >= 0 else len(content)].decode("utf-8", "replace").rstrip("\r")
        parts = line.rsplit(" ", len(names) - 1)
        if line.startswith("filedesc://"):  # its own fields are not defined yet: the length is the last one
            parts = [line.split(" ")[0], line.split(" ")[-1]]
        if len(parts) < 2 or not parts[-1].isdigit() or (len(parts) != len(names) and not line.startswith("filedesc://")):
            raise ValueError(f"no ARC record header at byte {at}: {line[:80]!r}")
        length, body_at = int(parts[-1]), (end + 1 if end >= 0 else len(content))
        body = content[body_at:body_at + length]
        if line.startswith("filedesc://"):
            lines = body.decode("utf-8", "replace").splitlines()
            version, names = int(lines[0].split()[0]), lines[1].split()
            if names != FIELDS.get(version, "").split():
                raise ValueError(f"ARC version {version} with fields {names} is not known")
        else:
            field = dict(zip(names, parts))
            head, payload = split_http(body)
            yield {"offset": at, "version": version, "url": field["URL"], "ip": field["IP-address"],
                   "date": field["Archive-date"], "mime": field["Content-type"], "head": head, "payload": payload,
                   "truncated": len(body) < length}
        at = body_at + length


def parse_arc(archives: DataFrame) -> DataFrame:
    """(archive, content) rows -> one row per record (see RECORDS)."""
    bound_batches(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("version", pa.int32()), ("url", pa.string()),
                            ("ip", pa.string()), ("date", pa.string()), ("mime", pa.string()), ("head", pa.binary()),
                            ("payload", pa.binary()), ("truncated", pa.bool_())])
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = [{"archive": name, **r} for r in arc_records(inflate(content.as_py() or b""))]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return archives.select("archive", "content").mapInArrow(run, RECORDS)


# --- conversion ----------------------------------------------------------------------


def with_revisits(records: DataFrame, key: str, min_bytes: int = 100) -> DataFrame:
    """Add payload_bytes, payload_digest, record_type, refers_to (the response's key).

    Keys and digests are gathered first; the payloads only meet the keys of revisits.
    """
    records = records.withColumn("payload_bytes", F.length("payload").cast("long")).withColumn(
        "payload_digest", F.sha2("payload", 256))
    short = materialize(records.where(F.col("payload_bytes") >= min_bytes).select(F.col(key).alias("key"), "payload_digest"))
    first = materialize(short.groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("refers_to"))
                        .where("n > 1").drop("n"))
    again = materialize(short.join(first, "payload_digest").where("key > refers_to")
                        .select("key", "payload_digest", "refers_to").distinct())
    return (records.join(again.withColumnRenamed("key", key), [key, "payload_digest"], "left")
            .withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")))


def record_id(key: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{key}:{digest}')}>"


def timestamp(date: str) -> str:
    """14-digit date as WARC-Date; missing digits are the earliest moment of what is given."""
    digits = re.sub(r"\D", "", date)[:14]
    full = digits + "00000101000000"[len(digits):]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def warc_record(r: dict) -> bytes:
    """One WARC record without the two line ends that close it."""
    revisit = r["record_type"] == "revisit"
    block = r["head"] + (b"" if revisit else r["payload"])
    kind = "application/http;msgtype=response" if r["head"] else (r["mime"] or "application/octet-stream")
    fields = [("WARC-Type", "revisit" if revisit else ("response" if r["head"] else "resource")),
              ("WARC-Record-ID", record_id(r["key"], r["payload_digest"])), ("WARC-Date", timestamp(r["date"])),
              ("WARC-Target-URI", r["url"]), ("WARC-IP-Address", r["ip"]), ("Content-Type", kind),
              ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()),
              ("WARC-Payload-Digest", "sha256:" + r["payload_digest"])]
    if revisit:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(r["refers_to"], r["payload_digest"])),
                   ("X-Refers-To-Page-Id", str(r["refers_to"]))]
    if r["truncated"]:
        fields.append(("WARC-Truncated", "length"))
    if r["key"] is not None:
        fields.append(("X-Page-Id", str(r["key"])))
    fields += [("X-Payload-Length", str(r["payload_bytes"])), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block


def warc_archives(records: DataFrame, key: str, size: int = ARCHIVE_BYTES) -> DataFrame:
    """Records with their types -> WARC archives (content) of about ``size`` bytes."""
    columns = ["url", "ip", "date", "mime", "head", "payload", "truncated", "payload_bytes", "payload_digest",
               "record_type", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held = [], 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(kept)], pa.binary())], names=["content"])
        for batch in batches:
            for i in range(batch.num_rows):
                kept.append(warc_record({c: batch.column(j)[i].as_py() for j, c in enumerate(["key", *columns])}))
                held += len(kept[-1])
                if held >= size:
                    yield archive()
                    kept, held = [], 0
        if kept:
            yield archive()

    return records.select(F.col(key).cast("long").alias("key"), *columns).mapInArrow(run, "content binary")


# --- files ---------------------------------------------------------------------------


def write_archives(archives: DataFrame, path: str, end: str = "\r\n\r\n") -> None:
    """One gzip file per row; ``end`` closes the last record (the text writer adds it)."""
    (archives.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).option("lineSep", end)
     .option("compression", "gzip").text(path))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder as (archive, content)."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("archive"), "content")


def inflate(content: bytes) -> bytes:
    """Contents of a gzip file with any number of members; anything else as it is."""
    if content[:2] != b"\x1f\x8b":
        return content
    out, rest = [], content
    while rest[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(rest) + member.flush())
        rest = member.unused_data
    return b"".join(out)


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record, blocks by Content-Length."""
    at = 0
    while at < len(content):
        if content[at] in b"\r\n":
            at += 1
            continue
        end = content.find(b"\r\n\r\n", at)
        if not content.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) for line in content[at:end].decode().split("\r\n")[1:])
        length = int(fields["Content-Length"])
        yield fields, content[end + 4:end + 4 + length]
        at = end + 4 + length


def read_warc(archives: DataFrame) -> DataFrame:
    """(archive, content) rows -> page_id, payload_bytes, payload_digest, record_type, refers_to, url, date, record_id.

    Digest and length of kept payloads are computed from the bytes read; a record whose
    header says otherwise raises an error.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in warc_records(inflate(content.as_py() or b"")):
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    size, back = int(fields["X-Payload-Length"]), fields.get("X-Refers-To-Page-Id")
                    if kind != "revisit":
                        payload = split_http(block)[1] if kind == "response" else block
                        if (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
                            raise ValueError(f"{fields['WARC-Record-ID']}: payload and header differ")
                    own = fields.get("X-Page-Id")
                    rows.append((None if own is None else int(own), size, digest, kind, None if back is None else int(back),
                                 fields["WARC-Target-URI"], fields["WARC-Date"], fields["WARC-Record-ID"]))
                if rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["page_id", "payload_bytes", "payload_digest", "record_type",
                                                                     "refers_to", "url", "date", "record_id"])

    return archives.select("content").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, "
             "date string, record_id string")


def convert_pages(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
                  min_bytes: int = 100, size: int = ARCHIVE_BYTES) -> DataFrame:
    """Lay pages out as ARC, convert, write WARC files under ``path`` and read them back."""
    records = parse_arc(arc_archives(pages, key, url, payload, size=size))
    numbered = records.withColumn("key", F.regexp_extract(F.decode("head", "ISO-8859-1"), r"X-Page-Id: (-?\d+)", 1))
    numbered = numbered.withColumn("key", F.when(F.col("key") != "", F.col("key").cast("long")))
    write_archives(warc_archives(with_revisits(numbered, "key", min_bytes), "key", size), path)
    return read_warc(read_archives(pages.sparkSession, path))
