"""WARC archives with one zstandard frame per record and a dictionary of their own.

An archive starts with a skippable frame that holds its dictionary; then every
record is a frame, so that any of them can be decoded alone. Archives travel as
Parquet rows (``archive``, ``content``), or as files read with Spark's binary source.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import written

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads below this size are never replaced by a revisit.
LEAST_REVISIT = 100
#: Bytes of records in an archive; one longer record has an archive of its own.
ARCHIVE_BYTES = 4 << 20
#: A record that decodes to more is an error: a small frame can claim any size.
LARGEST_RECORD = 1 << 29
DICTIONARY_BYTES = 16 << 10
#: An archive's dictionary learns from at most this much of its records, evenly spread.
LEARNED_BYTES = 1 << 20
DATE = "2000-01-01T00:00:00Z"

_ARCHIVES = "archive string, records long, content binary"
_RECORDS = (
    "record_id string, record_type string, target_uri string, payload_digest string, "
    "payload_bytes long, refers_to string, payload binary, error string"
)


# Writing


def described(pages: DataFrame) -> DataFrame:
    """Each page with its payload, digest, record type and the page it refers to."""
    found = pages.select(
        F.col("page_id"),
        F.col("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= LEAST_REVISIT
    firsts = written(
        found.filter(large)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .filter("copies > 1 AND first_id IS NOT NULL")
        .drop("copies"),
        "warc-firsts",
    )
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    return found.join(firsts, "digest", "left").select(
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        "digest",
        F.octet_length("payload").cast("long").alias("size"),
        F.when(revisit, F.col("first_id")).cast("string").alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def _uri(url: str | None) -> str | None:
    """Without blanks and control characters, which would end a header line."""
    if url is None:
        return None
    bad = {c for c in url if ord(c) <= 0x20 or 0x7F <= ord(c) < 0xA0 or c in "  "}
    for c in bad:
        url = url.replace(c, "".join(f"%{b:02X}" for b in c.encode()))
    return url


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return (
        VERSION + b"\r\n" + lines.encode() + b"Content-Length: %d\r\n\r\n" % len(block)
        + block + b"\r\n\r\n"
    )


def page_record(page_id, url, digest, size, refers_to, payload) -> bytes:
    """A response with its payload, or a revisit of another page's response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    return _record(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", _uri(url)),
            ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>" if revisit else None),
            ("WARC-Profile", REVISIT_PROFILE if revisit else None),
            ("Content-Type", "application/http;msgtype=response"),
        ],
        http if revisit else http + payload,
    )


def _dictionary(records: list[bytes]) -> bytes:
    """A dictionary trained on the archive's own records; empty if they are too few."""
    step = max(1, -(-sum(map(len, records)) // LEARNED_BYTES))
    samples = [record[: LEARNED_BYTES // 8] for record in records[::step]]
    if len(samples) < 8:
        return b""
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too little to learn from
        return b""


def archive(records: list[bytes]) -> bytes:
    trained = _dictionary(records)
    out = []
    options = {"level": 3, "write_content_size": True, "write_checksum": True}
    if trained:
        # The dictionary is itself a frame, compressed without any dictionary.
        packed = zstandard.ZstdCompressor(level=19).compress(trained)
        out.append(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
        options["dict_data"] = zstandard.ZstdCompressionDict(trained)
    compressor = zstandard.ZstdCompressor(**options)
    out.extend(compressor.compress(record) for record in records)
    return b"".join(out)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    records: list[bytes] = []
    size = number = 0
    names = ["archive", "records", "content"]

    def done() -> pa.RecordBatch:
        row = [[f"pages-{part:06d}-{number:06d}.warc.zst"], [len(records)], [archive(records)]]
        kinds = (pa.string(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(v, kind) for v, kind in zip(row, kinds, strict=True)], names
        )

    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            record = page_record(*[value.as_py() for value in row])
            if records and size + len(record) > ARCHIVE_BYTES:
                yield done()
                records, size, number = [], 0, number + 1
            records.append(record)
            size += len(record)
    if records:
        yield done()


def write_archives(pages: DataFrame) -> DataFrame:
    """The archives of ``pages`` (page_id, url, html): ``archive``, ``records``,
    ``content``. A null html is an empty payload, a null url has no target header.

    Of records with equal payloads of 100 bytes and more, those of the smallest
    page_id are responses and the others revisit it; a null page_id counts as the
    largest. An empty table has no archives.
    """
    return described(pages).mapInArrow(_write, _ARCHIVES)


# Reading


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame at ``at`` ends, from its header and block headers."""
    if int.from_bytes(data[at : at + 4], "little") != FRAME_MAGIC:
        raise ValueError("not a zstandard frame")
    if at + 5 > len(data):
        raise ValueError("a frame is cut short")
    described_by = data[at + 4]
    single = described_by >> 5 & 1
    size_bytes = (1 if single else 0, 2, 4, 8)[described_by >> 6]
    at += 5 + (0 if single else 1) + (0, 1, 2, 4)[described_by & 3] + size_bytes
    while True:
        if at + 3 > len(data):
            raise ValueError("a frame is cut short")
        block = int.from_bytes(data[at : at + 3], "little")
        if block >> 1 & 3 == 3:
            raise ValueError("a block of a kind that does not exist")
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            break
    at += 4 if described_by >> 2 & 1 else 0
    if at > len(data):
        raise ValueError("a frame is cut short")
    return at


def decode(frame: bytes | memoryview, trained: zstandard.ZstdCompressionDict | None = None) -> bytes:
    """One frame, decoded; more than ``LARGEST_RECORD`` bytes are an error."""
    options = {"dict_data": trained} if trained else {}
    out = zstandard.ZstdDecompressor(**options).stream_reader(frame).read(LARGEST_RECORD + 1)
    if len(out) > LARGEST_RECORD:
        raise ValueError("a frame is too large")
    return out


def frame_places(data: memoryview) -> Iterator[tuple[int, int]]:
    """Where the frames of an archive begin and end, skippable ones included."""
    at = 0
    while at < len(data):
        if int.from_bytes(data[at : at + 4], "little") & 0xFFFFFFF0 == 0x184D2A50:
            end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
            if end > len(data):
                raise ValueError("a frame is cut short")
        else:
            end = frame_end(data, at)
        yield at, end
        at = end


def frames(content: bytes) -> Iterator[bytes | ValueError]:
    """The decoded frames of an archive, one at a time.

    A frame whose end is known but that cannot be decoded gives an error in its place,
    and what follows it is read; one whose end cannot be found raises it.
    """
    data, trained = memoryview(content), None
    for at, end in frame_places(data):
        magic = int.from_bytes(data[at : at + 4], "little")
        if magic != FRAME_MAGIC:
            if magic == DICTIONARY_MAGIC and at == 0:
                own = bytes(data[8:end])
                try:
                    packed = int.from_bytes(own[:4], "little") == FRAME_MAGIC
                    trained = zstandard.ZstdCompressionDict(decode(own) if packed else own)
                except zstandard.ZstdError as error:
                    raise ValueError(f"the dictionary cannot be read: {error}") from error
            continue
        try:
            yield decode(data[at:end], trained)
        except (ValueError, zstandard.ZstdError) as error:
            yield ValueError(str(error))


def _number(text: str) -> int | None:
    """A length as headers write it: ASCII digits and not too many of them."""
    return int(text) if text.isascii() and text.isdigit() and len(text) < 19 else None


def parse(record: bytes) -> dict:
    """The fields of ``_RECORDS`` of one record; ``error`` says what is wrong with it."""
    found = dict.fromkeys(
        ("record_id", "record_type", "target_uri", "payload_digest", "payload_bytes", "refers_to", "payload", "error")
    )

    def wrong(error: str) -> dict:
        found["error"] = error
        return found

    head, blank, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not blank or not lines[0].startswith(b"WARC/1."):
        return wrong("no record header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return wrong("a header line without a colon")
        fields[name.decode("utf-8", "replace").lower()] = value.decode("utf-8", "replace").strip()
    found["record_type"] = fields.get("warc-type")
    found["record_id"] = fields.get("warc-record-id")
    found["target_uri"] = fields.get("warc-target-uri")
    found["refers_to"] = fields.get("warc-refers-to")
    found["payload_digest"] = fields.get("warc-payload-digest", "").rpartition(":")[2] or None
    length = _number(fields.get("content-length", ""))
    needed = (found["record_type"], found["record_id"], fields.get("warc-date"))
    if not all(needed) or length is None:
        return wrong("a needed header is missing")
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        return wrong("the length does not match")
    block = rest[:length]
    if found["record_type"] not in ("response", "revisit"):
        found["payload"], found["payload_bytes"] = block, len(block)
        return found
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [x.split(b":")[1].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    told = _number(sizes[0].decode("latin-1")) if sizes else None
    found["payload_bytes"] = len(payload) if told is None else told
    if found["record_type"] == "response":
        found["payload"] = payload
        if found["payload_bytes"] != len(payload):
            return wrong("the payload's length does not match")
        if found["payload_digest"] not in (None, hashlib.sha256(payload).hexdigest()):
            return wrong("the payload's digest does not match")
    elif not found["refers_to"]:
        return wrong("a revisit refers to nothing")
    return found


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}

    def of(rows: list[dict]) -> pa.RecordBatch:
        names = list(rows[0])
        return pa.RecordBatch.from_arrays(
            [pa.array([row[n] for row in rows], kinds.get(n, pa.string())) for n in names], names
        )

    for batch in batches:
        for content in batch.column("content"):
            rows, size = [], 0
            try:
                for frame in frames(content.as_py() or b""):
                    if isinstance(frame, ValueError):
                        rows.append(parse(b"") | {"error": str(frame)})
                        continue
                    rows.append(parse(frame))
                    size += len(frame)
                    if size > ARCHIVE_BYTES:
                        yield of(rows)
                        rows, size = [], 0
            except ValueError as error:
                # What follows a broken frame cannot be found: say so in a row.
                rows.append(parse(b"") | {"error": str(error)})
            if rows:
                yield of(rows)


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of archives in the column ``content``.

    Every record's headers, lengths and payload digest are checked; ``error`` names
    the first fault and is null for a sound record. A frame that cannot be decoded, or
    that decodes to more than ``LARGEST_RECORD`` bytes, is a row that has only an error;
    one whose end cannot be found ends its archive with such a row. A null content has no
    rows, nor has an empty one.
    """
    return archives.select("content").mapInArrow(_read, _RECORDS)


def page_of(record_id):
    return F.regexp_extract(record_id, r"^<urn:page:(.*)>$", 1)


def pages_through_archives(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives and read these back, one row per page.

    A null html is an empty payload; a null page_id stays null and is never referred to
    while another page has the payload; repeated rows give a record each; an empty table
    gives no rows. Other columns are not looked at.
    """
    archives = prepare_archives(pages)
    kind = pages.schema["page_id"].dataType
    return read_archives(archives).select(
        F.nullif(page_of(F.col("record_id")), F.lit("")).cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.nullif(page_of(F.col("refers_to")), F.lit("")).cast(kind).alias("refers_to"),
        "error",
    )


def prepare_archives(pages: DataFrame) -> DataFrame:
    """The archives of ``pages`` as a stored table."""
    return written(write_archives(pages), "warc-archives")
