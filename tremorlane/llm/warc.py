"""WARC archives of pages, each record compressed alone with a dictionary of its archive."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlane.llm.common import file_uri, slices, staged, utf8
from tremorlane.staging import fresh_dir

MIN_REVISIT_BYTES = 0
ARCHIVE_BYTES = 64 << 20
#: The dictionary of an archive comes from its first records, so many bytes of them at most.
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
DATE = "1970-01-01T00:00:00Z"

_SKIPPABLE = 0x184D2A5D
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_END = b"\r\n\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(urn: bytes) -> int | None:
    number = urn.removeprefix(b"<urn:page:").removesuffix(b">")
    return int(number) if number else None


def record(page_id, url, payload: bytes, digest: str, refers_to=None, revisit=False) -> bytes:
    """One WARC/1.1 record; a revisit has headers only."""
    block = b"" if revisit else _HTTP % len(payload) + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {page_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or 'urn:unknown', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines[6:6] = [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {page_urn(refers_to)}"]
    return "\r\n".join(lines).encode() + _END + block + _END


def parse(raw: bytes) -> dict:
    """Headers and payload of a record; a revisit has no payload."""
    head, _, rest = raw.partition(_END)
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    block = rest[: int(fields[b"Content-Length"])]
    payload = None
    if fields[b"WARC-Type"] == b"response":
        payload = block.partition(_END)[2]
    return {"fields": fields, "payload": payload}


def _dictionary(records: list[bytes], size: int) -> bytes:
    """A dictionary trained on the records, or none where they are too few for one."""
    try:
        return zstandard.train_dictionary(size, records, k=1024, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


class Writer:
    """Archives of a task: a skippable frame with the dictionary, then one frame a record.

    Records are held back until there are enough of them for the dictionary.
    A file gets its final name when it is whole, by a move that replaces what
    an earlier attempt of the task left.
    """

    def __init__(self, root: str, part: int, attempt: int, limits: tuple[int, int, int]):
        self.files, self.root = pyarrow.fs.FileSystem.from_uri(root)
        self.part, self.attempt = part, attempt
        self.most, self.sample, self.size = limits
        self.number, self.out = 0, None
        self.held: list[bytes] = []
        self.bytes = self.records = 0
        self.done: list[tuple[str, int]] = []

    def add(self, raw: bytes) -> None:
        self.bytes += len(raw)
        self.records += 1
        if self.out is None:
            self.held.append(raw)
            if self.bytes >= self.sample:
                self._open()
        else:
            self.out.write(self.press.compress(raw))
        if self.bytes >= self.most:
            self.close()

    def _open(self) -> None:
        trained = _dictionary(self.held, self.size)
        self.name = f"{self.root}/part-{self.part:06d}-{self.number:06d}.warc.zst"
        opened = f"{self.name}.{self.attempt}.open"
        self.out = self.files.open_output_stream(opened, compression=None)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(trained)) + trained)
        known = zstandard.ZstdCompressionDict(trained) if trained else None
        self.press = zstandard.ZstdCompressor(dict_data=known, write_content_size=True)
        for raw in self.held:
            self.out.write(self.press.compress(raw))
        self.held = []

    def close(self) -> None:
        if not self.records:
            return
        if self.out is None:
            self._open()
        self.out.close()
        self.files.move(f"{self.name}.{self.attempt}.open", self.name)
        self.done.append((self.name.rpartition("/")[2], self.records))
        self.number, self.out = self.number + 1, None
        self.bytes = self.records = 0


def read_archive(stream) -> Iterator[bytes]:
    """The records of an archive, one after the other."""
    magic, length = struct.unpack("<II", stream.read(8))
    if magic != _SKIPPABLE:
        raise ValueError("not an archive with a leading dictionary frame")
    trained = stream.read(length)
    known = zstandard.ZstdCompressionDict(trained) if trained else None
    rest = b""
    press = zstandard.ZstdDecompressor(dict_data=known)
    while True:
        frame, parts = press.decompressobj(), []
        while not frame.eof:
            chunk = rest or stream.read(1 << 20)
            if not chunk:
                if parts:
                    raise ValueError("archive ends inside a record")
                return
            parts.append(frame.decompress(chunk))
            rest = frame.unused_data
        yield b"".join(parts)


def planned(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages with payload, digest and whether they revisit another.

    Digests and their largest page_id are counted on their own columns; only
    the join brings the pages themselves together with them. It is keyed by a
    hash on both sides, so AQE can split a payload that many pages share.
    """
    payload = utf8("html")
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url"),
        payload.alias("payload"),
        # Two digests, as different payloads with one SHA-1 can be made.
        F.concat(F.sha1(payload), F.sha2(payload, 256)).alias("sha"),
    )
    large = own.where(F.octet_length("payload") >= min_bytes)
    first = large.groupBy("sha").agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
    first = first.where("n > 1").select(
        "original", F.col("sha").alias("_sha"), F.xxhash64("sha").alias("_h")
    )
    joined = own.withColumn("_k", F.xxhash64("sha")).join(
        first,
        (F.col("_k") == F.col("_h"))
        & (F.col("sha") == F.col("_sha"))
        & (F.octet_length("payload") >= min_bytes),
        "left",
    )
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return joined.select("page_id", "url", "payload", "original", revisit.alias("revisit"))


def write_archives(
    pages: DataFrame,
    root: str,
    min_bytes: int = MIN_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    sample_bytes: int = SAMPLE_BYTES,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> DataFrame:
    """Write one record per page to archives under `root`; gives (file, records).

    `root` is a URI that all executors can write to. An archive is closed at
    `archive_bytes` of records and its dictionary trained on the first
    `sample_bytes` of them. The archives are written when this returns.
    """
    limits = (archive_bytes, sample_bytes, dictionary_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        writer = Writer(root, task.partitionId(), task.taskAttemptId(), limits)
        for batch in slices(batches, "payload"):
            for row in batch.to_pylist():
                digest = payload_digest(row["payload"])
                writer.add(
                    record(
                        row["page_id"], row["url"], row["payload"], digest, row["original"], row["revisit"]
                    )
                )
        writer.close()
        files, counts = zip(*writer.done, strict=True) if writer.done else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(files, pa.string()), pa.array(counts, pa.int64())], ["file", "records"]
        )

    _folder(pages.sparkSession, root)
    return staged(planned(pages, min_bytes).mapInArrow(run, "file string, records long"), "archives")


def _folder(spark: SparkSession, root: str) -> None:
    files, path = pyarrow.fs.FileSystem.from_uri(root)
    files.create_dir(path, recursive=True)


def read_archives(archives: DataFrame, root: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload), from the files.

    Length and digest of a response are those of the payload that was read;
    a digest that differs from the record's own is an error. A revisit has no
    payload, and the length and digest its header names.
    """
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.binary()),
        ]
    )

    def row(raw: bytes) -> dict:
        found = parse(raw)
        fields, payload = found["fields"], found["payload"]
        digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()
        size = int(fields[b"WARC-Payload-Length"])
        if payload is not None and (payload_digest(payload) != digest or len(payload) != size):
            raise ValueError(f"damaged record {fields[b'WARC-Record-ID'].decode()}")
        referred = fields.get(b"WARC-Refers-To")
        return {
            "page_id": _page_id(fields[b"WARC-Record-ID"]),
            "payload_bytes": size,
            "payload_digest": digest,
            "record_type": fields[b"WARC-Type"].decode(),
            "refers_to": None if referred is None else _page_id(referred),
            "payload": payload,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = pyarrow.fs.FileSystem.from_uri(root)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    rows, held = [], 0
                    for raw in read_archive(stream):
                        rows.append(row(raw))
                        held += len(raw)
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    ddl = (
        "page_id long, payload_bytes long, payload_digest string, record_type string,"
        " refers_to long, payload binary"
    )
    # One file at a time is the unit of work: as many tasks as files, at most.
    count = max(1, archives.count())
    return archives.repartition(count, "file").mapInArrow(run, ddl)


def archive_pages(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, **limits: int) -> DataFrame:
    """Write the pages to archives in the shared folder and read these back.

    The payload of a page is its html in UTF-8, null being empty. Of pages
    with equal payloads of at least `min_bytes` bytes the one with the largest
    page_id is a response and the others revisit it; smaller ones are all
    responses. A null page_id counts as smaller than any; where all of a group
    are null, all are responses, and so are repeated rows of the largest
    page_id. A null url becomes `urn:unknown`. Only `page_id`, `url` and
    `html` are read; an empty table gives no rows.
    """
    root = file_uri(fresh_dir(pages.sparkSession, "warc"))
    return read_archives(write_archives(pages, root, min_bytes, **limits), root)

