"""Legacy archives to WARC.

An ARC file is a version block and then records: one header line, the number
of bytes that the line declares, and a line feed. Version 1 lines have five
fields, version 2 lines ten. :func:`read_arc` cuts a file by the declared
lengths alone, :func:`convert` gives each record what WARC wants beside it
(record id, ISO time, type, block and payload digests; a revisit for a payload
that another record already holds), :func:`write_warc` and :func:`read_warc`
write and read WARC files.

Files are written by Spark's text writer (the last bytes of a record are its
line separator) and read whole, one task a file, so a writer deals records out
into files of a target size. Both kinds are gzip-compressed by the file.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, materialize
from .common import reachable, text_pieces

#: Bytes of payload in a file, on average.
FILE_BYTES = 16 << 20
#: Level of the files' gzip: less work than the usual one for somewhat more bytes.
GZIP = {"compression": "gzip", "zlib.compress.level": "THREE"}
#: Payloads shorter than this are stored again rather than revisited.
LEAST_REVISIT = 100

# Fixed values of the formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id bigint, url string, ip string, date string, version int, head binary, payload binary"


def _header_text(value: str | None) -> str:
    """A value for a header line or field: no white space or control characters."""
    return "".join(c if c > " " and c != "\x7f" else "%%%02X" % ord(c) for c in value or "") or "-"


# ---- ARC ---------------------------------------------------------------------------------------


def arc_block(version: int, name: str, date: str) -> bytes:
    """The version block: a record on the file itself, with the names of the fields."""
    body = f"{version} 0 Ledgerline\n{ARC_FIELDS[version]}\n".encode()
    return arc_line(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", len(body), name) + body


def arc_line(version: int, url: str, ip: str, date: str, kind: str, length: int, name: str) -> bytes:
    rest = [str(length)] if version == 1 else ["200", "-", "-", "0", name, str(length)]
    return (" ".join([_header_text(url), ip, date, _header_text(kind), *rest]) + "\n").encode()


def parse_arc(raw: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(version, fields, content) of every record after the version block.
    ValueError where a line or a length doesn't fit."""
    version, at = 0, 0
    names: list[str] = []
    while at < len(raw):
        if raw[at:at + 1] == b"\n":  # parts records
            at += 1
            continue
        end = raw.index(b"\n", at)
        fields = raw[at:end].decode("utf-8").split(" ")
        length = int(fields[-1])
        content = raw[end + 1:end + 1 + length]
        if len(content) != length or length < 0:
            raise ValueError(f"record at byte {at} declares {length} bytes and has {len(content)}")
        at = end + 1 + length
        if not version:
            if not fields[0].startswith("filedesc://"):
                raise ValueError("no version block")
            first, own = content.decode().split("\n")[:2]
            version, names = int(first.split(" ")[0]), own.split(" ")
            if ARC_FIELDS.get(version) != own:
                raise ValueError(f"unknown ARC version or fields: {first}; {own}")
            continue
        if len(fields) != len(names):
            raise ValueError(f"record at byte {at} has {len(fields)} fields; version {version} has {len(names)}")
        yield version, dict(zip(names, fields, strict=True)), content


def _files(total: int, file_bytes: int) -> int:
    return max(1, -(-total // file_bytes))


def write_arc(pages: DataFrame, path: str, date: str = "20200101000000", file_bytes: int = FILE_BYTES) -> None:
    """Legacy files of ``pages`` (page_id, url, html): an HTTP response each,
    its page number in a response field; every second file is of version 2.
    Null html has an empty payload, a null url is written as ``-``."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    total = pages.agg(F.coalesce(F.sum(F.octet_length(html)), F.lit(0))).first()[0]
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    files = _files(total, file_bytes)
    dealt = rows.repartition(files, F.xxhash64("page_id", "url")) if files > 1 else rows.coalesce(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId()
        version, name = 1 + number % 2, f"legacy-{number:06d}.arc"
        first = True
        for batch in batches:
            for part in text_pieces(batch, "html"):
                out = [arc_block(version, name, date)] if first else []
                first = False
                for page, url, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    own = "" if page is None else f"X-Page-Id: {page}\r\n"
                    body = text.encode()
                    content = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(body)}\r\n\r\n".encode() + body
                    out.append(arc_line(version, url or "-", "0.0.0.0", date, "text/html", len(content), name) + content)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    dealt.mapInArrow(run, "value binary").select(F.col("value").cast("string")) \
        .write.option("lineSep", "\n").options(**GZIP).text(path)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the ARC files in ``path``, as RECORD: the HTTP head, and the
    payload behind it (content without a head is all payload)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content"):
                yield from _pieces(_arc_record(*r) for r in parse_arc(_unzipped(raw.as_py())))

    return _whole_files(spark, path).mapInArrow(run, RECORD)


def _arc_record(version: int, fields: dict[str, str], content: bytes) -> tuple:
    head, payload = _split_http(content)
    return _page_id(head), fields["URL"], fields["IP-address"], fields["Archive-date"], version, head, payload


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()),
                     ("version", pa.int32()), ("head", pa.binary()), ("payload", pa.binary())])


def _pieces(rows: Iterator[tuple], schema: pa.Schema = _SCHEMA, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about ``limit`` bytes."""
    kept: list[tuple] = []
    size = 0
    for row in rows:
        kept.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept, strict=True), schema.types, strict=True)], schema.names)
            kept, size = [], 0
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept, strict=True), schema.types, strict=True)], schema.names)


def _split_http(content: bytes) -> tuple[bytes, bytes]:
    if not content.startswith(b"HTTP/"):
        return b"", content
    head, mark, payload = content.partition(b"\r\n\r\n")
    return head + mark, payload


def _page_id(head: bytes) -> int | None:
    for line in head.split(b"\r\n"):
        if line.lower().startswith(b"x-page-id:"):
            return int(line.split(b":", 1)[1])
    return None


def _unzipped(raw: bytes) -> bytes:
    """Bytes of one or more gzip members."""
    out = []
    while raw:
        member = zlib.decompressobj(31)
        out.append(member.decompress(raw) + member.flush())
        raw = member.unused_data
    return b"".join(out)


def _whole_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


# ---- WARC --------------------------------------------------------------------------------------


def convert(records: DataFrame, files: int) -> DataFrame:
    """RECORD with digest (SHA-256 of the payload), record_id, record_type,
    refers_to (page) and refers_to_id, dealt into ``files`` partitions.

    Of records with equal payloads of LEAST_REVISIT bytes or more, the one with
    the smallest page number (no number: last; then by record id) is the
    response, and the others revisit it. Digests are grouped and joined on
    narrow rows; payloads are moved once, by their own record id, so a payload
    that a third of all records hold is in no task's way. The narrow rows are
    written once, so records are read twice in all, and the join hashes the
    revisits of a file instead of sorting its payloads. Repeated records have
    one record id and share their fate.
    """
    # A version-5 style id from what identifies the capture.
    name = F.sha1(F.concat_ws(" ", "url", "date", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), "digest"))
    full = records.withColumn("digest", F.sha2("payload", 256)).withColumn("_h", name).withColumn("record_id", F.concat(
        F.lit("urn:uuid:"), F.substring("_h", 1, 8), F.lit("-"), F.substring("_h", 9, 4), F.lit("-5"), F.substring("_h", 14, 3),
        F.lit("-a"), F.substring("_h", 18, 3), F.lit("-"), F.substring("_h", 21, 12))).drop("_h")
    narrow = materialize(full.where(F.octet_length("payload") >= LEAST_REVISIT).select("digest", "record_id", "page_id"), "payload-digests")
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", "record_id"))
    firsts = narrow.groupBy("digest").agg(first.alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    revisits = narrow.join(firsts, "digest").where(F.col("_first.record_id") != F.col("record_id")) \
        .select("record_id", F.col("_first.page_id").alias("refers_to"), F.col("_first.record_id").alias("refers_to_id")).distinct()
    return full.repartition(files, "record_id").join(revisits.repartition(files, "record_id").hint("shuffle_hash"), "record_id", "left") \
        .withColumn("record_type", F.when(F.col("refers_to_id").isNotNull(), "revisit").otherwise(
            F.when(F.octet_length("head") == 0, "resource").otherwise("response")))


def iso_date(date: str) -> str:
    """14 digits to ISO 8601; missing digits are those of the first moment."""
    full = date + "00000101000000"[len(date):]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """All but the two line ends after the block, which the writer's line separator adds."""
    lines = [WARC_VERSION, f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields),
             f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def write_warc(converted: DataFrame, path: str) -> None:
    """One gzip-compressed WARC file a partition, each with its warcinfo record first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            for part in text_pieces(batch, "payload"):
                out = []
                for r in part.to_pylist():
                    date = iso_date(r["date"])
                    if first:
                        first = False
                        out.append(warc_record("warcinfo", [
                            ("WARC-Record-ID", f"<{uuid.uuid5(uuid.NAMESPACE_URL, 'info ' + r['record_id']).urn}>"), ("WARC-Date", date),
                            ("Content-Type", "application/warc-fields")], b"software: ledgerline\r\nformat: WARC File Format 1.1\r\n"))
                    fields = [("WARC-Record-ID", f"<{r['record_id']}>"), ("WARC-Date", date), ("WARC-Target-URI", r["url"]),
                              ("WARC-IP-Address", r["ip"]), ("WARC-Payload-Digest", f"sha256:{r['digest']}"),
                              ("X-Payload-Length", str(len(r["payload"])))]
                    block = r["head"] + r["payload"]
                    if r["record_type"] == "revisit":
                        block = r["head"]
                        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{r['refers_to_id']}>")]
                        if r["refers_to"] is not None:
                            fields.append(("X-Refers-To-Page-Id", str(r["refers_to"])))
                    fields.append(("Content-Type", "application/http; msgtype=response" if r["head"] else "application/octet-stream"))
                    out.append(warc_record(r["record_type"], fields, block))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    converted.mapInArrow(run, "value binary").select(F.col("value").cast("string")) \
        .write.option("lineSep", "\r\n\r\n").options(**GZIP).text(path)


def parse_warc(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields with lower-case names, block) of every record, by declared
    lengths. ValueError where a version, a length or a digest doesn't fit."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        version, *lines = raw[at:end].decode().split("\r\n")
        if not version.startswith("WARC/1."):
            raise ValueError(f"no record at byte {at}")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = int(fields["content-length"])
        block = raw[end + 4:end + 4 + length]
        at = end + 4 + length + 4
        if len(block) != length or raw[at - 4:at] != b"\r\n\r\n":
            raise ValueError(f"{fields.get('warc-record-id')} does not have the {length} bytes that it declares")
        if (digest := fields.get("warc-block-digest")) and digest != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise ValueError(f"{fields.get('warc-record-id')}: its block has another digest")
        yield fields, block


CAPTURE = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Captures of the WARC files in ``path``: page_id, url, date, record_id,
    record_type, payload_bytes and payload_digest (of the full payload, for
    revisits as they state them; for others recomputed and compared),
    refers_to, payload (null for revisits). warcinfo records are left out."""

    def rows(raw: bytes) -> Iterator[tuple]:
        for fields, block in parse_warc(raw):
            kind = fields["warc-type"]
            if kind == "warcinfo":
                continue
            head, payload = _split_http(block)
            digest, size = fields["warc-payload-digest"].removeprefix("sha256:"), int(fields["x-payload-length"])
            if kind != "revisit" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                raise ValueError(f"{fields['warc-record-id']}: its payload has another digest or length")
            page = fields.get("x-refers-to-page-id")
            yield (_page_id(head), fields["warc-target-uri"], fields["warc-date"], fields["warc-record-id"].strip("<>"), kind, size, digest,
                   None if page is None else int(page), None if kind == "revisit" else payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content"):
                yield from _pieces(rows(_unzipped(raw.as_py())), CAPTURE)

    return _whole_files(spark, path).mapInArrow(run, "page_id bigint, url string, date string, record_id string, record_type string, "
                                                     "payload_bytes bigint, payload_digest string, refers_to bigint, payload binary")


def convert_archives(spark: SparkSession, arc_path: str, warc_path: str, file_bytes: int = FILE_BYTES) -> None:
    """Convert all ARC files in a folder."""
    reachable(spark)
    packed = spark.read.format("binaryFile").load(arc_path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    write_warc(convert(read_arc(spark, arc_path), _files(packed * 4, file_bytes)), warc_path)  # text is about four times its gzip size


def archive_pages(pages: DataFrame) -> DataFrame:
    """Captures read back from WARC files that were converted from ARC files of
    ``pages`` (page_id, url, html; other columns are not read), in new folders
    of the shared work folder.

    A row a page. Null html is an empty payload; a null or odd url is written
    in a form that a header line can hold; a page without number stays so.
    Repeated rows are repeated records, all response or all revisit. No pages
    give no files and no rows.
    """
    spark = pages.sparkSession
    arc, warc = fresh_path(spark, "arc"), fresh_path(spark, "warc")
    write_arc(pages, arc)
    convert_archives(spark, arc, warc)
    return read_warc(spark, warc)
