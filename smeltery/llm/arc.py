"""Converting legacy ARC archives to WARC.

Both formats are sequences of a header, a body of declared length and a separator. Archives are
written by Spark's text writer, whose record separator is the format's own, so a file is an archive
as it stands (compressed as a whole) in any store Spark writes to, and is committed with its task.
They are read line by line or block by block as a stream within one task, and put together by the
declared lengths; a task holds one Arrow batch and one record.

ARC has two header lines, told apart by the definition line of the file's first block:
version 1 has five fields, version 2 ten. What WARC asks for and both lack is synthesised: ids (a UUID
from what the record says, so that a repeated task writes the same), dates, types and digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.llm.shared import scratch, slices, text_bytes

# The definition lines of the two versions.
DEFINITIONS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
    "Archive-length",
}
ARC_END, WARC_END = "\n", "\r\n\r\n"
CAPTURED = datetime(2001, 1, 1, tzinfo=timezone.utc)
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: that of URLs
# Records are handed on in batches of about this many bytes.
BATCH = 4 << 20
WRITE = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
MIN_REVISIT = 1000


# --- writing ARC


def _clean_url(url: str | None) -> str:
    """A URL without the white space that ends a field; a missing one is "-"."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "-"


def arc_header(version: int, url: str, date: str, mime: str, length: int, **more: object) -> str:
    if version == 1:
        return f"{url} 0.0.0.0 {date} {mime} {length}"
    fields = (more.get("code", 200), more.get("checksum", "-"), "-", more["offset"], more["name"])
    return f"{url} 0.0.0.0 {date} {mime} {' '.join(map(str, fields))} {length}"


def version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 smeltery\n{DEFINITIONS[version]}\n".encode()
    url = f"filedesc://{name}"
    head = arc_header(version, url, date, "text/plain", len(body), offset=0, name=name)
    return f"{head}\n".encode() + body


def http_response(page_id: int | None, payload: bytes) -> bytes:
    ident = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{ident}"
    return f"{head}Content-Length: {len(payload)}\r\n\r\n".encode() + payload


def write_arc(
    pages: DataFrame,
    path: str,
    versions: tuple[int, ...] = (1, 2),
    page_id: str = "page_id",
    url: str = "url",
    markup: str = "html",
) -> None:
    """One archive per partition, its version taken in turn from ``versions``.

    Each page is an HTTP response whose body is the page in UTF-8, empty if it is missing. ARC has
    no field for the page's id, so it is a header of the response; a missing id has none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        version, name = versions[number % len(versions)], f"pages-{number:06d}.arc"
        first = version_block(version, name, f"{CAPTURED:%Y%m%d%H%M%S}")
        offset, started = len(first) + 1, False
        for part in slices(batches):
            out = [] if started else [first]
            started = True
            for ident, address, page in zip(*(c.to_pylist() for c in part.columns), strict=True):
                body = http_response(ident, page)
                date = CAPTURED + timedelta(seconds=(ident or 0) % 10**9)
                head = arc_header(
                    version,
                    _clean_url(address),
                    f"{date:%Y%m%d%H%M%S}",
                    "text/html",
                    len(body),
                    offset=offset,
                    name=name,
                )
                record = f"{head}\n".encode() + body
                offset += len(record) + 1
                out.append(record)
            yield pa.record_batch([pa.array(out, pa.binary())], ["record"])

    rows = pages.select(
        F.col(page_id).cast("bigint"), F.col(url).cast("string"), text_bytes(markup)
    )
    records = rows.mapInArrow(run, "record BINARY").select(F.col("record").cast("string"))
    records.write.option("lineSep", ARC_END).options(**WRITE).text(path)


# --- reading both


class _Stream:
    """Bytes of one file, taken from the front."""

    def __init__(self) -> None:
        self.data, self.at = b"", 0

    def feed(self, data: bytes) -> None:
        self.data, self.at = self.data[self.at :] + data, 0

    def find(self, mark: bytes) -> int:
        return self.data.find(mark, self.at)

    def left(self) -> int:
        return len(self.data) - self.at

    def take(self, n: int) -> bytes:
        self.at += n
        return self.data[self.at - n : self.at]


class TruncatedArchive(ValueError):
    """A file ends before a record's declared length."""


@dataclass(frozen=True)
class Record:
    fields: dict[str, str]
    body: bytes


class ArcReader:
    """Records of one ARC file, fed in any pieces; the file's first block fixes the version."""

    end = ARC_END.encode()

    def __init__(self) -> None:
        self.stream, self.names, self.head = _Stream(), DEFINITIONS[1].split(), None

    def feed(self, data: bytes) -> Iterator[Record]:
        stream = self.stream
        stream.feed(data)
        while True:
            if self.head is None:
                while stream.left() and stream.data[stream.at : stream.at + 1] == b"\n":
                    stream.at += 1
                end = stream.find(b"\n")
                if end < 0:
                    return
                self.head = self._parse(stream.take(end + 1 - stream.at)[:-1])
            length = int(self.head["Archive-length"])
            if stream.left() < length:
                return
            record, self.head = Record(self.head, stream.take(length)), None
            if record.fields["URL"].startswith("filedesc://"):
                self._define(record.body)
            yield record

    def _parse(self, line: bytes) -> dict[str, str]:
        """The fields by name. Before the definition is known, by their number."""
        text = line.decode("utf-8", "replace").rstrip("\r")
        names = self.names
        if text.startswith("filedesc://") and len(text.split(" ")) >= 10:
            names = DEFINITIONS[2].split()
        # Old crawlers left blanks in URLs, so the other fields are counted from the end.
        values = text.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"not an ARC header: {text[:200]!r}")
        return dict(zip(names, values, strict=True))

    def _define(self, body: bytes) -> None:
        lines = body.decode("utf-8", "replace").splitlines()
        if len(lines) > 1 and lines[1].startswith("URL "):
            self.names = lines[1].split()

    def close(self) -> None:
        if self.head is not None or self.stream.data[self.stream.at :].strip():
            raise TruncatedArchive("an ARC file ends within a record")


class WarcReader:
    """Records of one WARC file, fed in any pieces."""

    end = WARC_END.encode()

    def __init__(self) -> None:
        self.stream, self.head = _Stream(), None

    def feed(self, data: bytes) -> Iterator[Record]:
        stream = self.stream
        stream.feed(data)
        while True:
            if self.head is None:
                end = stream.find(b"\r\n\r\n")
                if end < 0:
                    return
                self.head = self._parse(stream.take(end + 4 - stream.at)[:-4])
            length = int(self.head["content-length"])
            if stream.left() < length + 4:
                return
            record, self.head = Record(self.head, stream.take(length)), None
            if stream.take(4) != b"\r\n\r\n":
                raise ValueError("a WARC record's declared length is wrong")
            yield record

    @staticmethod
    def _parse(block: bytes) -> dict[str, str]:
        first, *lines = block.decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:200]!r}")
        pairs = (line.partition(":") for line in lines)
        return {name.strip().lower(): value.strip() for name, _, value in pairs}

    def close(self) -> None:
        if self.head is not None or self.stream.data[self.stream.at :].strip():
            raise TruncatedArchive("a WARC file ends within a record")


def _records(batches: Iterator[pa.RecordBatch], reader: type) -> Iterator[Record]:
    """Records of the files whose pieces, in order, are the rows (file, bytes)."""
    file = now = None
    for batch in batches:
        names, pieces = batch.column(0), batch.column(1)
        start = 0
        while start < batch.num_rows:
            name = names[start].as_py()
            # Rows of a file stand together, and a batch rarely holds more than one.
            end = batch.num_rows if names[batch.num_rows - 1].as_py() == name else start + 1
            while end < batch.num_rows and names[end].as_py() == name:
                end += 1
            if name != file:
                if now is not None:
                    now.close()
                file, now = name, reader()
            values = pieces.slice(start, end - start).to_pylist()
            yield from now.feed(reader.end.join(values) + reader.end)
            start = end
    if now is not None:
        now.close()


def _pieces(spark: SparkSession, path: str, end: str) -> DataFrame:
    """(file, bytes between separators); compressed files are read in order by one task each."""
    rows = spark.read.option("lineSep", end).text(path)
    return rows.select(F.col("_metadata.file_path"), F.col("value").cast("binary"))


def split_http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, header bytes and payload of an HTTP message; anything else is all payload."""
    if not block.startswith(b"HTTP/"):
        return {}, b"", block
    head, blank, payload = block.partition(b"\r\n\r\n")
    pairs = (line.partition(":") for line in head.decode("latin-1").split("\r\n")[1:])
    return {n.strip().lower(): v.strip() for n, _, v in pairs}, head + blank, payload


def _id(headers: dict[str, str], name: str) -> int | None:
    return int(headers[name]) if headers.get(name, "").lstrip("-").isdigit() else None


def read_arc(spark: SparkSession, path: str, with_block: bool = True) -> DataFrame:
    """Records of ARC files of either version, without the files' own descriptions.

    ``url``, ``ip``, ``date`` (ISO 8601), ``mime``, ``page_id``, ``payload_bytes``, ``digest`` (SHA-1 of
    the payload, hex), and ``block``, the whole body, if asked for.
    """
    kinds = {
        "url": pa.string(),
        "ip": pa.string(),
        "date": pa.string(),
        "mime": pa.string(),
        "page_id": pa.int64(),
        "payload_bytes": pa.int64(),
        "digest": pa.string(),
    } | ({"block": pa.binary()} if with_block else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for record in _records(batches, ArcReader):
            fields = record.fields
            if fields["URL"].startswith("filedesc://"):
                continue
            headers, _, payload = split_http(record.body)
            row = (
                fields["URL"],
                fields["IP-address"],
                iso_date(fields["Archive-date"]),
                fields["Content-type"],
                _id(headers, "x-page-id"),
                len(payload),
                hashlib.sha1(payload).hexdigest(),
            )
            rows.append((*row, record.body) if with_block else row)
            held += len(record.body) if with_block else 256
            if held >= BATCH:
                yield _batch(rows, kinds)
                rows, held = [], 0
        if rows:
            yield _batch(rows, kinds)

    schema = "url STRING, ip STRING, date STRING, mime STRING, page_id BIGINT, payload_bytes BIGINT"
    schema += ", digest STRING" + ", block BINARY" * with_block
    return _pieces(spark, path, ARC_END).mapInArrow(run, schema)


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)]
    return pa.record_batch(arrays, names=list(kinds))


def iso_date(digits: str) -> str:
    """ARC dates have 14 digits, in old files fewer; what is missing is the earliest possible."""
    full = digits[:14] + "00000101000000"[len(digits[:14]) :]
    try:
        return f"{datetime.strptime(full, '%Y%m%d%H%M%S'):%Y-%m-%dT%H:%M:%SZ}"
    except ValueError:
        return "1970-01-01T00:00:00Z"


# --- writing WARC


def record_id(url: str, date: str, page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{url} {date} {page_id} {digest}')}>"


def labelled(raw: bytes) -> str:
    return f"sha1:{base64.b32encode(raw).decode()}"


def warc_record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the separator that ends it."""
    lines = [f"{name}: {value}" for name, value in fields if value is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return f"{head}\r\n\r\n".encode() + block


def converted(row: dict) -> bytes:
    """The WARC record of one ARC record; with ``keeper`` it revisits that page's response."""
    block, keeper = row["block"], row["keeper"]
    head = split_http(block)[1]
    revisit = keeper is not None
    if revisit:
        block = head
    # A response has the server's head; what came without one is the resource itself.
    kind = "revisit" if revisit else "response" if head else "resource"
    payload_digest = labelled(bytes.fromhex(row["digest"]))
    content = "application/http; msgtype=response" if head else row["mime"]
    return warc_record(
        [
            ("WARC-Type", kind),
            ("WARC-Record-ID", record_id(row["url"], row["date"], row["page_id"], row["digest"])),
            ("WARC-Date", row["date"]),
            ("WARC-Target-URI", row["url"]),
            ("WARC-IP-Address", row["ip"]),
            ("WARC-Block-Digest", labelled(hashlib.sha1(block).digest())),
            ("WARC-Payload-Digest", payload_digest),
            (
                "WARC-Profile",
                "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                if revisit
                else None,
            ),
            ("WARC-Refers-To", row["keeper_record"] if revisit else None),
            ("X-Refers-To-Page-Id", keeper),
            ("X-Payload-Length", row["payload_bytes"]),
            ("X-Page-Id", row["page_id"]),
            ("Content-Type", content),
        ],
        block,
    )


def convert(spark: SparkSession, arc: str, warc: str, min_revisit: int = MIN_REVISIT) -> None:
    """Write the WARC archives of all ARC records under a path.

    Of records with equal payloads of ``min_revisit`` bytes or more, the one of the largest page id
    keeps its payload and the others become revisits of it. Records that repeat that id all keep
    theirs, and records without id never revisit nor are revisited among themselves. The keepers
    are found from digests alone; payloads are moved once, to meet the keeper of their digest.
    """
    seen = read_arc(spark, arc, with_block=False).where(F.col("payload_bytes") >= min_revisit)
    found = F.max(F.struct("page_id", "url", "date")).alias("last")
    keepers = (
        seen.where(F.col("page_id").isNotNull())
        .groupBy("digest", "payload_bytes")
        .agg(F.count(F.lit(1)).alias("n"), found)
        .where(F.col("n") > 1)
        .select("digest", "payload_bytes", "last")
    )
    both = read_arc(spark, arc).join(keepers, ["digest", "payload_bytes"], "left")
    revisits = (F.col("last.page_id") != F.col("page_id")) & F.col("page_id").isNotNull()
    rows = both.select(
        *["url", "ip", "date", "mime", "page_id", "payload_bytes", "digest", "block"],
        *[F.when(revisits, F.col(f"last.{c}")).alias(f"k_{c}") for c in ("page_id", "url", "date")],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, started = TaskContext.get().partitionId(), False
        for part in slices(batches):
            out = []
            if not started:
                started = True
                name = f"pages-{number:06d}.warc"
                body = b"software: smeltery\r\nformat: WARC File Format 1.1\r\n"
                date = f"{CAPTURED:%Y-%m-%dT%H:%M:%SZ}"
                out.append(
                    warc_record(
                        [
                            ("WARC-Type", "warcinfo"),
                            ("WARC-Record-ID", record_id(name, date, None, "")),
                            ("WARC-Date", date),
                            ("WARC-Filename", name),
                            ("Content-Type", "application/warc-fields"),
                        ],
                        body,
                    )
                )
            for row in part.to_pylist():
                row["keeper"] = row["k_page_id"]
                if row["keeper"] is not None:
                    row["keeper_record"] = record_id(
                        row["k_url"], row["k_date"], row["keeper"], row["digest"]
                    )
                out.append(converted(row))
            yield pa.record_batch([pa.array(out, pa.binary())], ["record"])

    records = rows.mapInArrow(run, "record BINARY").select(F.col("record").cast("string"))
    records.write.option("lineSep", WARC_END).options(**WRITE).text(warc)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Responses and revisits of WARC files.

    ``page_id``, ``url``, ``payload_bytes``, ``payload_digest`` (bare hex SHA-1), ``record_type``,
    ``refers_to``. A stored payload's length and digest are measured and must be those declared; a
    revisit has only the declared ones.
    """
    kinds = {
        "page_id": pa.int64(),
        "url": pa.string(),
        "payload_bytes": pa.int64(),
        "payload_digest": pa.string(),
        "record_type": pa.string(),
        "refers_to": pa.int64(),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for record in _records(batches, WarcReader):
            fields = record.fields
            kind = fields.get("warc-type")
            if kind == "warcinfo":
                continue
            digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2])
            length = _id(fields, "x-payload-length")
            if kind != "revisit":
                payload = split_http(record.body)[2]
                if hashlib.sha1(payload).digest() != digest:
                    raise ValueError(f"{fields['warc-record-id']}: payload and digest differ")
                length = len(payload)
            rows.append(
                (
                    _id(fields, "x-page-id"),
                    fields.get("warc-target-uri"),
                    length,
                    digest.hex(),
                    kind,
                    _id(fields, "x-refers-to-page-id"),
                )
            )
            if len(rows) == 4096:
                yield _batch(rows, kinds)
                rows = []
        if rows:
            yield _batch(rows, kinds)

    return _pieces(spark, path, WARC_END).mapInArrow(
        run,
        "page_id BIGINT, url STRING, payload_bytes BIGINT, payload_digest STRING, "
        "record_type STRING, refers_to BIGINT",
    )


def archived(pages: DataFrame, min_revisit: int = MIN_REVISIT, **columns: str) -> DataFrame:
    """Pages written as ARC, converted to WARC and read back; an empty table gives no rows."""
    spark = pages.sparkSession
    folder = scratch(spark, "archives")
    write_arc(pages, f"{folder}/arc", **columns)
    convert(spark, f"{folder}/arc", f"{folder}/warc", min_revisit)
    return read_warc(spark, f"{folder}/warc")
