from __future__ import annotations

import hashlib
import struct

import pyarrow as pa
import pytest
import zstandard

from tradelake.llm import warc

SCHEMA = "page_id bigint, url string, html string, digest string, payload string, size int"
SAME = "<p>" + "same page " * 30 + "</p>"
ROWS = [
    (5, "http://a.example/x y", SAME),
    (3, "http://a.example/\r\nX-Bad: 1", SAME),
    (9, None, SAME),
    (None, "http://a.example/n", SAME),
    (3, "http://a.example/again", SAME),
    (1, "http://b.example/", "short"),
    (2, "http://b.example/", "short"),
    (4, "http://b.example/", None),
    (6, "http://b.example/", ""),
    (7, "http://c.example/é", "é" * 50),
    (8, "http://c.example/é", "é" * 50),
    (10, "http://c.example/", "x" * 99),
    (11, "http://c.example/", "x" * 99),
    (12, "http://c.example/", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 9),
    (13, "http://c.example/", "long " * 2_000_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*row, "d", "p", 1) for row in ROWS], SCHEMA)


def test_pages_through_archives(pages):
    wanted = []
    for page_id, _, html in ROWS:
        data = (html or "").encode()
        same = [p for p, _, h in ROWS if (h or "").encode() == data and p is not None]
        first = min(same) if len(data) >= 100 and len(same) > 1 else page_id
        visits = len(data) >= 100 and first != page_id
        wanted.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if visits else "response", first if visits else None, None))
    found = [tuple(row) for row in warc.pages_through_archives(pages).collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_records_hold_the_payload(pages):
    records = warc.read_archives(warc.write_archives(pages)).collect()
    held = sorted(bytes(r.payload).decode() for r in records if r.record_type == "response")
    first = {}
    for page_id, _, html in ROWS:
        key = html if html and len(html.encode()) >= 100 else (page_id, html)
        first.setdefault(key, html or "")
    # The page that is there twice, with the smallest id, is a response both times.
    assert held == sorted([*first.values(), SAME])
    assert all("\n" not in (r.target_uri or "") for r in records)


def test_given_pages_share_a_dictionary(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for row in warc.write_archives(pages).collect():
        magic, size = struct.unpack("<II", row.content[:8])
        assert magic == warc.DICTIONARY_MAGIC
        own = zstandard.ZstdDecompressor().decompress(bytes(row.content[8 : 8 + size]))
        assert zstandard.ZstdCompressionDict(own).dict_id()
        assert len(list(warc.frames(bytes(row.content)))) == row.records


def test_frames_of_other_writers():
    """Without dictionary, with unknown sizes, checksums, raw and empty blocks."""
    records = [b"", b"a", b"abc" * 100_000, bytes(range(256)) * 2000]
    content = b"".join(
        zstandard.ZstdCompressor(level=1, write_content_size=i % 2 == 0, write_checksum=i % 3 == 0).compress(r)
        for i, r in enumerate(records)
    )
    skipped = struct.pack("<II", 0x184D2A50, 5) + b"other"
    assert list(warc.frames(skipped + content)) == records


def test_faults_are_named(spark):
    good = warc.page_record("1", "http://a/", hashlib.sha256(b"x").hexdigest(), 1, None, b"x")
    broken = {
        "length": good.replace(b"Content-Length: 1\r\n", b"Content-Length: 2\r\n"),
        "digest": good.replace(b"\r\n\r\nx\r\n\r\n", b"\r\n\r\ny\r\n\r\n"),
        "header": good.replace(b"WARC-Type: response\r\n", b""),
        "no record": b"not a record",
        "colon": good.replace(b"WARC-Date: ", b"WARC-Date "),
    }
    assert warc.parse(good)["error"] is None
    for record in [good.replace(b"Content-Length: ", b"Content-Length: 1", 1), *broken.values()]:
        assert warc.parse(record)["error"]
    content = warc.archive([good, broken["digest"], good])
    cut = content[:-5]
    frame = spark.createDataFrame([(content,), (cut,), (b"",), (None,), (b"junk junk",)], "content binary")
    rows = warc.read_archives(frame).collect()
    assert sum(r.error is None for r in rows) == 3
    assert sum(r.error is not None for r in rows) == 4


def test_empty_table(pages):
    assert warc.pages_through_archives(pages.limit(0)).collect() == []


def sound(text: bytes) -> bytes:
    return warc.page_record("1", "http://a/", hashlib.sha256(text).hexdigest(), len(text), None, text)


def read(content):
    """Payloads of the sound records and the number of errors, as a task reads them."""
    batch = pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])
    rows = [row for part in warc._read(iter([batch])) for row in part.to_pylist()]
    return [r["payload"] for r in rows if r["error"] is None], sum(r["error"] is not None for r in rows)


@pytest.mark.parametrize("with_dictionary", [False, True])
def test_an_archive_cut_anywhere(with_dictionary):
    texts = [b"<p>%d</p>" % i * 30 for i in range(20 if with_dictionary else 3)]
    content = warc.archive([sound(t) for t in texts])
    data = memoryview(content)
    places = [p for p in warc.frame_places(data) if int.from_bytes(data[p[0] : p[0] + 4], "little") == warc.FRAME_MAGIC]
    assert (int.from_bytes(content[:4], "little") == warc.DICTIONARY_MAGIC) == with_dictionary
    for cut in range(len(content)):
        whole = sum(end <= cut for _, end in places)
        at_a_border = cut in (0, places[0][0], *(end for _, end in places))
        assert read(content[:cut]) == (texts[:whole], 0 if at_a_border else 1), cut


def test_any_byte_of_an_archive_may_be_wrong():
    """No crash; records before the damaged frame come back, as do those after it as long
    as its end is known."""
    texts = [b"<p>%d</p>" % i * 20 for i in range(3)]
    content = warc.archive([sound(t) for t in texts])
    ends = [end for _, end in warc.frame_places(memoryview(content))]
    after = 0
    for at in range(len(content)):
        for value in (0, 255, content[at] ^ 1):
            found, _ = read(content[:at] + bytes([value]) + content[at + 1 :])
            hit = sum(end <= at for end in ends)
            assert found[:hit] == texts[:hit]
            after += hit == 1 and found[-1:] == texts[2:]
    assert after > 30


def test_a_record_with_odd_lengths_ends_nothing():
    good = sound(b"x")
    odd = [good.replace(b"Content-Length: 1\r\n", b"Content-Length: %s\r\n" % n) for n in ("²".encode(), b"9" * 5000, b"-1", b"")]
    odd += [good.replace(b"Length: ", "Length: ²".encode(), 1), b"\xff\xfe\r\n\r\n", b""]
    content = b"".join(zstandard.ZstdCompressor().compress(r) for r in [good, *odd, good])
    found, errors = read(content)
    assert found[0] == found[-1] == b"x" and len(found) + errors == len(odd) + 2


def test_frames_may_not_decode_to_any_size(monkeypatch):
    monkeypatch.setattr(warc, "LARGEST_RECORD", 10_000)
    bomb = zstandard.ZstdCompressor().compress(b"\0" * 1_000_000)
    ok = zstandard.ZstdCompressor().compress(sound(b"x"))
    assert read(ok + bomb + ok) == ([b"x", b"x"], 1)
