"""Archives: round trip, revisits, and the file format."""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow.fs
import pytest
import zstandard

from tremorlane.llm.common import file_uri
from tremorlane.llm.warc import archive_pages, parse, read_archive, write_archives
from tremorlane.staging import fresh_dir

PAGE = "<html><head><title>%d</title></head><body class='main'>%s</body></html>"
ROWS = [
    *((i, f"https://host.example/{i}", PAGE % (i, "text " * (i % 40))) for i in range(300)),
    (400, "http://a/ü b\r\nX: y", "same"),
    (401, None, "same"),
    (399, "http://c", "same"),
    (402, "http://d", None),
    (403, "http://e", ""),
    (404, "http://f", "\r\n\r\nWARC/1.1\r\n\r\n é 日本"),
    (405, "http://g", "x" * 3_000_000),
    (None, "http://h", "same"),
    (None, "http://i", "alone"),
    (None, "http://j", "alone"),
    (406, "http://k", "twice"),
    (406, "http://k", "twice"),
]


def expected(min_bytes):
    payloads = [(row[0], (row[2] or "").encode()) for row in ROWS]
    out = []
    for page_id, payload in payloads:
        group = [i for i, other in payloads if other == payload and i is not None]
        original = max(group, default=None)
        revisit = original is not None and page_id != original and len(payload) >= min_bytes
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kind = "revisit" if revisit else "response"
        out.append((page_id or -1, len(payload), digest, kind, original if revisit else -1, payload))
    return sorted(out)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(shipped, min_bytes):
    pages = shipped.createDataFrame(
        [(*row, "x", "y") for row in ROWS],
        "page_id long, url string, html string, payload string, sha string",
    )
    found = archive_pages(pages, min_bytes, archive_bytes=1 << 20, sample_bytes=20_000, dictionary_bytes=4096)
    rows = []
    for row in found.collect():
        refers = -1 if row["refers_to"] is None else row["refers_to"]
        rows.append(
            (row["page_id"] or -1, row["payload_bytes"], row["payload_digest"], row["record_type"], refers)
        )
        if row["record_type"] == "response":
            assert len(row["payload"]) == row["payload_bytes"]
        else:
            assert row["payload"] is None
    assert sorted(rows) == [row[:5] for row in expected(min_bytes)]


def test_format(shipped):
    pages = shipped.createDataFrame(ROWS[:300], "page_id long, url string, html string")
    root = file_uri(fresh_dir(shipped, "warc"))
    written = write_archives(pages.coalesce(1), root, sample_bytes=20_000, dictionary_bytes=4096)
    files, path = pyarrow.fs.FileSystem.from_uri(root)
    seen = 0
    for name, count in written.collect():
        with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
            data = stream.read()
        magic, size = struct.unpack_from("<II", data)
        assert magic == 0x184D2A5D and size > 0
        known = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        # Every record is a frame of its own that the dictionary alone opens.
        frame = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
        raw = frame.decompress(data[8 + size :])
        assert frame.eof and raw.startswith(b"WARC/1.1\r\n") and raw.count(b"WARC-Type") == 1
        with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
            records = [parse(raw) for raw in read_archive(stream)]
        assert len(records) == count
        seen += count
        for found in records:
            fields, payload = found["fields"], found["payload"]
            digest = base64.b32encode(hashlib.sha1(payload).digest())
            assert fields[b"WARC-Payload-Digest"] == b"sha1:" + digest
    assert seen == 300


def test_no_pages(shipped):
    pages = shipped.createDataFrame([], "page_id long, url string, html string")
    assert archive_pages(pages).count() == 0
