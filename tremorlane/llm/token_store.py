"""Token ids in files of directly addressable codes."""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from tremorlane.llm.common import Remembered, file_uri, slices, staged, utf8
from tremorlane.llm.ragged import distinct_words, spread
from tremorlane.staging import fresh_dir

END_ID = 1
FILE_TOKENS = 4 << 20
CACHED = 250_000  # chunks of text a worker remembers
# Tasks share the cores already; threads of the library would only wait for each other.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
_MAGIC = b"DACids01"
_BLOCK = 512  # bits of a continuation bitmap under one entry of its rank directory


def pack(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of (chunks, continuation bitmap, rank directory) of unsigned 32-bit ids.

    The first level has the low byte of every id, the next one the second byte
    of those ids that go on, and so on. A bit of the bitmap says whether its
    id goes on; the directory has the number of ones before every 512th bit.
    """
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        ones = np.cumsum(np.r_[0, more], dtype=np.uint64)[:-1:_BLOCK] if len(more) else ()
        levels.append((rest.astype(np.uint8), bits, np.asarray(ones, np.uint64)))
        rest = rest[more] >> 8
        if not len(rest):
            return levels


def to_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A file: header, documents and their offsets, then the levels."""
    levels = pack(ids)
    parts = [
        _MAGIC,
        struct.pack("<QQI", len(doc_ids), len(ids), len(levels)),
        np.array([doc_id is None for doc_id in doc_ids], np.uint8).tobytes(),
        np.array([doc_id or 0 for doc_id in doc_ids], np.int64).tobytes(),
        np.cumsum([0, *lengths], dtype=np.uint64).tobytes(),
    ]
    for chunks, bits, ones in levels:
        parts += [struct.pack("<Q", len(chunks)), chunks.tobytes(), bits.tobytes(), ones.tobytes()]
    return b"".join(parts)


class TokenFile:
    """A file as views of its bytes; any token is reached without its neighbours."""

    def __init__(self, data: bytes):
        if data[:8] != _MAGIC:
            raise ValueError("not a file of directly addressable codes")
        docs, self.tokens, count = struct.unpack_from("<QQI", data, 8)
        self.at, self.data = 28, data
        nulls = self._view(np.uint8, docs)
        numbers = self._view(np.int64, docs)
        self.doc_ids = [
            None if null else number
            for null, number in zip(nulls.tolist(), numbers.tolist(), strict=True)
        ]
        self.offsets = self._view(np.uint64, docs + 1).astype(np.int64)
        self.levels = []
        for _ in range(count):
            (size,) = struct.unpack_from("<Q", data, self.at)
            self.at += 8
            chunks = self._view(np.uint8, size)
            bits = self._view(np.uint8, -(-size // 8))
            self.levels.append((chunks, bits, self._view(np.uint64, -(-size // _BLOCK))))

    def _view(self, kind, count: int) -> np.ndarray:
        view = np.frombuffer(self.data, kind, count, self.at)
        self.at += view.nbytes
        return view

    def _rank(self, level: int, position: int) -> int:
        """Ones of a bitmap before a position: a directory entry and part of one block."""
        _, bits, ones = self.levels[level]
        if position // _BLOCK >= len(ones):
            return len(self.levels[level + 1][0]) if level + 1 < len(self.levels) else 0
        first = position // _BLOCK * (_BLOCK // 8)
        piece = np.unpackbits(bits[first : position // 8 + 1], bitorder="little")
        return int(ones[position // _BLOCK]) + int(piece[: position % _BLOCK].sum())

    def token(self, position: int) -> int:
        """One id, by its position in the file."""
        value = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[position]) << 8 * level
            if not bits[position // 8] >> position % 8 & 1:
                break
            position = self._rank(level, position)
        return value

    def ids(self, first: int, end: int) -> np.ndarray:
        """Ids of a range, from the parts of the levels that belong to it."""
        out = np.zeros(end - first, np.uint32)
        where = np.arange(end - first)
        for level, (chunks, bits, _) in enumerate(self.levels):
            if first == end:
                break
            out[where] |= chunks[first:end].astype(np.uint32) << 8 * level
            more = np.unpackbits(bits[first // 8 : -(-end // 8)], bitorder="little")
            more = more[first % 8 :][: end - first].astype(bool)
            where = where[more]
            first = self._rank(level, first)
            end = first + len(where)
        return out

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, position of its first token, ids) of every document."""
        bounds, ids = self.offsets.tolist(), self.ids(0, self.tokens)
        for doc_id, first, end in zip(self.doc_ids, bounds, bounds[1:], strict=False):
            yield doc_id, first, ids[first:end]


#: A full stop or comma that no letter or digit precedes; an underscore is neither.
_LOOSE = re.compile(r"(?<![^\W_])[.,]")
_UNSAFE = (b"<|", b"\xcc", b"\xcd", b"\xc4\xb0")
_TOGETHER = 512  # words handed to the library as one text
_STOP = np.isin(np.arange(256), list(b".,"))
_TIGHT = np.array([i >= 0x80 or chr(i).isalnum() for i in range(256)])


def _is_word(text: str) -> bool:
    """Whether a chunk is one run of letters, also when composed and lower-cased."""
    return text.isalpha() and unicodedata.normalize("NFC", text).lower().isalpha()


def _suspects(texts: list[bytes]) -> np.ndarray:
    """Texts with a full stop or comma after something that may be no letter or digit.

    Letters are told by bytes: ASCII ones, and the second byte of U+00C0 to
    U+00FF but for the two signs among them.
    """
    codes = np.frombuffer(b"".join(b"\0\0" + text for text in texts), np.uint8)
    at = np.flatnonzero(_STOP[codes])
    last, lead = codes[at - 1], codes[at - 2]
    wide = (last < 0x80) | ((lead == 0xC3) & (last != 0x97) & (last != 0xB7))
    starts = np.cumsum([0] + [len(text) + 2 for text in texts])
    found = np.zeros(len(texts), bool)
    found[np.searchsorted(starts, at[~(_TIGHT[last] & wide)], "right") - 1] = True
    return found


# The rules of the tokenizer files that `LibraryIds` takes.
_RULES = {
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
    "split": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "byte_level": {"add_prefix_space": False, "use_regex": False},
    "model": {
        "type": "BPE",
        "dropout": None,
        "unk_token": None,
        "continuing_subword_prefix": None,
        "fuse_unk": False,
        "byte_fallback": False,
    },
}


def check_rules(path: str) -> None:
    """Refuse a tokenizer file that normalises or parts texts by other rules."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    steps = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
    model = told["model"]
    fits = [
        (told["normalizer"] or {}).get("normalizers") == _RULES["normalizers"],
        [step["type"] for step in steps] == ["Split", "ByteLevel"],
        bool(steps) and steps[0].get("pattern") == {"Regex": _RULES["split"]},
        bool(steps) and (steps[0].get("behavior"), steps[0].get("invert")) == ("Removed", True),
        bool(steps) and all(steps[-1].get(k) == v for k, v in _RULES["byte_level"].items()),
        all(model.get(k, v) == v for k, v in _RULES["model"].items()),
        all(
            token["content"].startswith("<|")
            and not any(token[k] for k in ("single_word", "lstrip", "rstrip", "normalized"))
            for token in told["added_tokens"]
        ),
    ]
    if not all(fits):
        raise ValueError(f"{path}: its rules are not those that chunks can be encoded apart by")


class LibraryIds:
    """Ids from the tokenizers library, which encodes each different chunk of text once.

    A chunk is a run without ASCII white space. The tokenizer must be one that
    drops white space, lower-cases, composes characters and parts letters and
    digits from other characters (`check_rules` refuses others): then chunks
    can be encoded apart. So can a full stop or comma and the letter or digit
    before it, and A-Z can be lower-cased beforehand, in texts without
    combining marks (bytes CC and CD, and C4 B0 which lower-cases to one) and
    without special tokens (`<|`); it leaves fewer different chunks. Words of
    a-z alone go to the library's model directly, as its other steps leave
    them as they are.
    """

    def __init__(self, path: str):
        check_rules(path)
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.plain = Tokenizer(self.library.model)
        self.plain.pre_tokenizer = WhitespaceSplit()
        self.known = Remembered(CACHED)
        self.suffix = getattr(self.library.model, "end_of_word_suffix", None)
        self.closes = np.zeros(self.library.get_vocab_size(), bool)
        if self.suffix:
            ids = [i for token, i in self.library.get_vocab().items() if token.endswith(self.suffix)]
            self.closes[ids] = True

    @staticmethod
    def prepared(texts: list[bytes]) -> list[bytes]:
        """Texts with fewer different chunks and the same ids."""
        out = []
        for text, suspect in zip(texts, _suspects(texts).tolist(), strict=True):
            if not any(mark in text for mark in _UNSAFE):
                if not suspect or not _LOOSE.search(text.decode()):
                    text = text.lower().replace(b".", b" .").replace(b",", b" ,")
            out.append(text)
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        chunks, place, before = distinct_words(self.prepared(texts))
        plain, words, others = [], [], []
        for chunk in self.known.absent(chunks):
            if not self.suffix:
                others.append(chunk)
            elif chunk.isalpha() and chunk.islower():
                plain.append(chunk)
            else:
                (words if _is_word(chunk.decode()) else others).append(chunk)
        self._learn_words(plain, self.plain)
        self._learn_words(words, self.library)
        for first in range(0, len(others), 4096):
            some = others[first : first + 4096]
            found = self.library.encode_batch_fast(
                [chunk.decode() for chunk in some], add_special_tokens=False
            )
            for chunk, encoding in zip(some, found, strict=True):
                self.known[chunk] = array("I", encoding.ids).tobytes()
        return spread(list(map(self.known.__getitem__, chunks)), place, before)

    def _learn_words(self, words: list[bytes], library: Tokenizer) -> None:
        """Encode many words as one text and cut its ids where tokens end a word."""
        groups = [words[i : i + _TOGETHER] for i in range(0, len(words), _TOGETHER)]
        texts = [b" ".join(group).decode() for group in groups]
        found = library.encode_batch_fast(texts, add_special_tokens=False)
        for group, encoding in zip(groups, found, strict=True):
            ids = np.array(encoding.ids, np.uint32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            raw, bounds = ids.astype("<u4").tobytes(), (4 * np.r_[0, ends]).tolist()
            self.known.update(
                zip(group, [raw[a:b] for a, b in zip(bounds, bounds[1:])], strict=True)
            )


@cache
def _library(path: str) -> LibraryIds:
    return LibraryIds(path)


_MANIFEST = "file string, part int, number int, tokens long"


def write_tokens(
    docs: DataFrame, root: str, tokenizer: str, end_id: int = END_ID, most: int = FILE_TOKENS
) -> DataFrame:
    """Encode documents into files under `root`, in ascending order of doc_id.

    Gives (file, part, number, tokens); ordered by part and number, the files
    follow one another. Documents are dealt out by ranges of doc_id (null
    first) and sorted there before they are encoded, so texts are shuffled
    once and ids never. A file is closed at `most` tokens and gets its name by
    a move when it is whole, replacing what an earlier attempt left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        files, path = pyarrow.fs.FileSystem.from_uri(root)
        doc_ids, parts, done, held = [], [], [], 0
        end = struct.pack("<I", end_id)

        def close() -> None:
            nonlocal held
            name = f"part-{part:06d}-{len(done):06d}.dac"
            lengths = [len(ids) // 4 for ids in parts]
            data = to_bytes(doc_ids, lengths, np.frombuffer(b"".join(parts), "<u4"))
            opened = f"{path}/{name}.{attempt}.open"
            with files.open_output_stream(opened, compression=None) as out:
                out.write(data)
            files.move(opened, f"{path}/{name}")
            done.append((name, part, len(done), held))
            doc_ids.clear()
            parts.clear()
            held = 0

        for batch in slices(batches, "text"):
            encoded = _library(tokenizer).encode(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                doc_ids.append(doc_id)
                parts.append(ids + end)
                held += len(ids) // 4 + 1
                if held >= most:
                    close()
        if doc_ids:
            close()
        columns = zip(*done, strict=True) if done else ((), (), (), ())
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64())
        arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["file", "part", "number", "tokens"])

    files, path = pyarrow.fs.FileSystem.from_uri(root)
    files.create_dir(path, recursive=True)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    ordered = source.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    return staged(ordered.mapInArrow(run, _MANIFEST), "tokens")


def read_tokens(manifest: DataFrame, root: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, from the files.

    `start` is the number of tokens of all documents before it, `ids` are
    little-endian unsigned 32-bit integers. Only the list of files, not that
    of documents, is put in order to find where each file starts.
    """
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(order), F.lit(0)))
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("start", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = pyarrow.fs.FileSystem.from_uri(root)
        for batch in batches:
            for name, base in zip(
                batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True
            ):
                with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    opened = TokenFile(stream.read())
                rows, held = [], 0
                for doc_id, first, ids in opened.documents():
                    raw = ids.astype("<u4").tobytes()
                    rows.append((doc_id, base + first, len(ids), raw))
                    held += len(raw)
                    if held >= 4 << 20:
                        yield _batch(rows, schema)
                        rows, held = [], 0
                yield _batch(rows, schema)

    count = max(1, manifest.count())
    ddl = "doc_id long, start long, n_tokens long, ids binary"
    return based.select("file", "base").repartition(count, "file").mapInArrow(run, ddl)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ((),) * len(schema)
    arrays = [pa.array(x, field.type) for x, field in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def stored_tokens(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, most: int = FILE_TOKENS
) -> DataFrame:
    """(doc_id, start, n_tokens, ids): documents encoded, stored and read back.

    `tokenizer` is a file of the tokenizers library that every executor can
    open. Each document ends with `end_id`; null and empty texts have only
    that. Strings of special tokens in a text are encoded as the library does
    by default. Rows of one doc_id follow one another in the order of the XXH64
    hash (seed 42, signed) of their texts, those without a doc_id come first. Only `doc_id` and `text` are
    read. An empty table gives no rows.
    """
    root = file_uri(fresh_dir(docs.sparkSession, "tokens"))
    return read_tokens(write_tokens(docs, root, tokenizer, end_id, most), root)


def stored_token_digest(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """`stored_tokens` with the crc32 of the ids in their place."""
    return stored_tokens(docs, tokenizer, end_id).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
