"""Two tokenizers' tokens over the same bytes, aligned by an associative fragment monoid."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256
from itertools import accumulate, chain, compress, pairwise, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlane.llm.common import Remembered, map_slices, shuffle_parts, slices, staged, utf8
from tremorlane.llm.forced_boundary import BoundaryBpe
from tremorlane.llm.ragged import distinct_parts, spread, taken

MARK = "▁"  # sentencepiece's sign for a space
CHUNK = 64 << 10  # texts of more bytes are cut into ranges of so many
FAN = 8  # neighbouring fragments that one task composes
CACHED = 120_000  # words a worker remembers between slices
_ID = 32  # bits of the second id in a pair


class Tokens(NamedTuple):
    """Tokens of both sides in order, with the byte offsets where they end."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def and_then(self, other: Tokens) -> Tokens:
        return Tokens(*map(np.concatenate, zip(self, other, strict=True)))

    def within(self, first: int, last: int) -> Tokens:
        """Those that end after `first` and not after `last`."""
        i, j = np.searchsorted(self.a_ends, [first, last], "right")
        k, n = np.searchsorted(self.b_ends, [first, last], "right")
        return Tokens(self.a[i:j], self.a_ends[i:j], self.b[k:n], self.b_ends[k:n])

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """A pair of ids for every two overlapping tokens, and the end of what they share.

        Between two neighbouring ends, of whichever side, lies one token of
        each side, and two tokens overlap in one such stretch only.
        """
        ends = np.union1d(self.a_ends, self.b_ends)
        left = self.a[np.searchsorted(self.a_ends, ends)].astype(np.int64)
        right = self.b[np.searchsorted(self.b_ends, ends)]
        return left << _ID | right, ends

    def groups(self) -> tuple[list[bytes], np.ndarray]:
        """Tokens between common ends, written `a1,a2|b1`, and these ends."""
        ends = np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)
        sides = []
        for ids, own in ((self.a, self.a_ends), (self.b, self.b_ends)):
            cuts = [0, *(np.searchsorted(own, ends) + 1).tolist()]
            names = list(map(str, ids.tolist()))
            sides.append([",".join(names[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)])
        return [f"{x}|{y}".encode() for x, y in zip(*sides, strict=True)], ends


NO_IDS, NO_ENDS = np.zeros(0, np.uint32), np.zeros(0, np.int64)
NO_TOKENS = Tokens(NO_IDS, NO_ENDS, NO_IDS, NO_ENDS)


class Groups(NamedTuple):
    """Closed groups: their text, their number, tokens of either side, and how often each pair is linked."""

    text: bytes = b""
    count: int = 0
    n_a: int = 0
    n_b: int = 0
    pairs: np.ndarray = NO_ENDS
    times: np.ndarray = NO_ENDS

    def and_then(self, other: Groups) -> Groups:
        if not self.count or not other.count:
            return self if self.count else other
        pairs, place = np.unique(np.r_[self.pairs, other.pairs], return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, place, np.r_[self.times, other.times])
        return Groups(
            self.text + b";" + other.text,
            self.count + other.count,
            self.n_a + other.n_a,
            self.n_b + other.n_b,
            pairs,
            times,
        )


def closed(tokens: Tokens) -> Groups:
    """Groups of tokens that begin and end where both sides do."""
    if not len(tokens.a):
        return Groups()
    texts, _ = tokens.groups()
    pairs, times = np.unique(tokens.links()[0], return_counts=True)
    return Groups(b";".join(texts), len(texts), len(tokens.a), len(tokens.b), pairs, times)


class Fragment(NamedTuple):
    """What the tokens that end in a byte range say, whatever lies before and behind it.

    `prefix` has the tokens up to the first common end, which belong to a
    group that may begin before the range; then come closed groups; `suffix`
    has the tokens after the last common end. Without a common end (`cut` is
    false) all tokens are in `prefix`. Composition is associative, and
    `Fragment()` is its neutral element.
    """

    cut: bool = False
    prefix: Tokens = NO_TOKENS
    groups: Groups = Groups()
    suffix: Tokens = NO_TOKENS

    def and_then(self, other: Fragment) -> Fragment:
        if not self.cut:
            return other._replace(prefix=self.prefix.and_then(other.prefix))
        if not other.cut:
            return self._replace(suffix=self.suffix.and_then(other.prefix))
        between = closed(self.suffix.and_then(other.prefix))
        groups = self.groups.and_then(between).and_then(other.groups)
        return Fragment(True, self.prefix, groups, other.suffix)

    def whole(self) -> Groups:
        """The groups of a range that begins and ends where both sides do, as a document does."""
        return closed(self.prefix).and_then(self.groups)


def fragment(tokens: Tokens) -> Fragment:
    common = np.intersect1d(tokens.a_ends, tokens.b_ends, assume_unique=True)
    if not len(common):
        return Fragment(prefix=tokens)
    first, last = int(common[0]), int(common[-1])
    end = int(max(tokens.a_ends[-1], tokens.b_ends[-1]))
    return Fragment(
        True, tokens.within(-1, first), closed(tokens.within(first, last)), tokens.within(last, end)
    )


class Word(NamedTuple):
    """A word between certain cuts; nothing of its fragment is open."""

    text: bytes
    links: bytes
    n_a: int
    n_b: int
    count: int
    sound: bool


class Aligner:
    """A byte-level BPE file and a sentencepiece BPE file, of which the second adds a space.

    Both tokenizers surely begin a token at a space after a visible ASCII
    character, or after one of two bytes. Texts, each after a space, are cut
    into words there, and different words are encoded and aligned once.
    """

    def __init__(self, first: str, second: str):
        self.coder = BoundaryBpe(first, specials=False, cached=CACHED)
        self.library = sentencepiece.SentencePieceProcessor(model_file=second)
        library = self.library
        pieces = [library.id_to_piece(i) for i in range(library.vocab_size())]
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError(f"{second}: pieces reach across words")
        if library.normalize(" a  ﬁ\n") != f"{MARK}{MARK}a{MARK}{MARK}ﬁ\n":
            raise ValueError(f"{second}: changes texts or adds no space")
        #: A space at the end of a text, which alone would be an empty text.
        self.space = library.encode("a ")[len(library.encode("a")) :]
        self.pieces = [
            bytes([int(piece[3:-1], 16)])
            if library.is_byte(i)
            else piece.replace(MARK, " ").encode()
            for i, piece in enumerate(pieces)
        ]
        self.a_sizes = np.array([len(token or b"") for token in self.coder.tokens])
        self.b_sizes = np.array(list(map(len, self.pieces)))
        #: Ids as text, before a comma, the end of a group's first side and the end of a group.
        most = max(len(self.a_sizes), len(self.b_sizes))
        self.written = [b"%d%b" % (i, sign) for i in range(most) for sign in (b",", b"|", b";")]
        self.written_sizes = np.array(list(map(len, self.written)))
        self.known = Remembered(CACHED)

    def starts(self, joined: bytes, bounds: np.ndarray) -> np.ndarray:
        return self.coder.starts(np.frombuffer(joined, np.uint8), bounds, b" ")

    def ids(self, words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """Ids of words that begin with a space, on both sides."""
        found = self.library.encode([word[1:].decode() for word in words], num_threads=1)
        found = [self.space if word == b" " else ids for word, ids in zip(words, found, strict=True)]
        cuts = list(accumulate(map(len, found), initial=0))
        raw = np.fromiter(chain.from_iterable(found), "<u4", cuts[-1]).tobytes()
        return self.coder.encode(words), [raw[4 * i : 4 * j] for i, j in pairwise(cuts)]

    def tokens(self, a: bytes, b: bytes, first: int = 0) -> Tokens:
        """Ids with the offsets of their ends, counted from `first`."""
        left, right = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
        ends = (first + np.cumsum(sizes) for sizes in (self.a_sizes[left], self.b_sizes[right]))
        return Tokens(left, next(ends), right, next(ends))

    def bytes_of(self, b: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(b, "<u4").tolist()))

    def learn(self, words: list[bytes]) -> list[Word]:
        new = self.known.absent(words)
        if new:
            a, b = self.ids(new)
            if self.bytes_of(b"".join(b)) != b"".join(new):
                sound = [self.bytes_of(ids) == word for word, ids in zip(new, b, strict=True)]
                odd = Word(b"", b"", 0, 0, 0, False)
                self.known.update((new[i], odd) for i, fits in enumerate(sound) if not fits)
                new, a, b = (list(compress(side, sound)) for side in (new, a, b))
            self.known.update(zip(new, self.aligned(new, a, b), strict=True))
        return list(map(self.known.__getitem__, words))

    def aligned(self, words: list[bytes], a: list[bytes], b: list[bytes]) -> Iterator[Word]:
        """Words with their ids, which give them back byte by byte, aligned in one pass."""
        tokens = self.tokens(b"".join(a), b"".join(b))
        upto = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        # By byte: 1 where a token of the first side ends, 2 of the second, 3 of both.
        marks = np.zeros(int(upto[-1]) + 1 if len(upto) else 1, np.uint8)
        marks[tokens.a_ends] = 1
        marks[tokens.b_ends] |= 2
        ends = np.flatnonzero(marks)
        kind = marks[ends]
        is_a, is_b, shut = kind & 1 > 0, kind > 1, kind == 3
        n_a, n_b, n_groups = (np.r_[0, np.cumsum(side)] for side in (is_a, is_b, shut))
        pairs = tokens.a[n_a[:-1]].astype(np.int64) << _ID | tokens.b[n_b[:-1]]
        last = np.searchsorted(ends, upto, "right")
        # Every token writes its id and what follows it; those of a group stand together, the first side first.
        closes = np.flatnonzero(shut)
        to_a, to_b = n_a[closes + 1], n_b[closes + 1]
        of_a, of_b = n_groups[:-1][is_a], n_groups[:-1][is_b]
        written = np.empty(len(tokens.a) + len(tokens.b), np.int64)
        last_a, last_b = np.zeros(len(tokens.a), bool), np.zeros(len(tokens.b), bool)
        last_a[to_a - 1] = last_b[to_b - 1] = True
        written[np.arange(len(of_a)) + np.r_[0, to_b][of_a]] = tokens.a.astype(np.int64) * 3 + last_a
        written[np.arange(len(of_b)) + to_a[of_b]] = tokens.b.astype(np.int64) * 3 + 2 * last_b
        text = b"".join(map(self.written.__getitem__, written.tolist()))
        behind = np.r_[0, np.cumsum(self.written_sizes[written])][n_a[last] + n_b[last]]
        raw = pairs.tobytes()
        texts = (text[i : j - 1] for i, j in pairwise([0, *behind.tolist()]))
        links = (raw[i:j] for i, j in pairwise([0, *(8 * last).tolist()]))
        counts = (np.diff(side[last], prepend=0).tolist() for side in (n_a, n_b, n_groups))
        return map(Word._make, zip(texts, links, *counts, repeat(True, len(words)), strict=True))

    def block(self, doc_ids: list[int | None], texts: list[bytes]) -> dict:
        """A block of documents; each is the composition of its words' fragments, made in bulk."""
        units = [b" " + text if text else b"" for text in texts]
        joined = b"".join(units)
        bounds = np.cumsum([0, *map(len, units)])
        starts = self.starts(joined, bounds) if joined else np.zeros(0, np.int64)
        words, place = distinct_parts(joined, starts, np.r_[starts[1:], len(joined)])
        found = self.learn(words)
        before = np.searchsorted(starts, bounds)

        def summed(values: np.ndarray) -> np.ndarray:
            upto = np.r_[0, np.cumsum(values[place])]
            return upto[before[1:]] - upto[before[:-1]]

        of_word, links, *numbers, sound = zip(*found, strict=True) if found else [()] * 6
        n_a, n_b, count = (summed(np.array(side, np.int64)) for side in numbers)
        unsound = summed(~np.array(sound, bool)) > 0
        for numbers in (n_a, n_b, count):
            numbers[unsound] = 0
        at = place.tolist()
        digests = [
            "" if bad or i == j else sha256(b";".join([of_word[n] for n in at[i:j]])).hexdigest()
            for bad, i, j in zip(unsound.tolist(), before.tolist(), before[1:].tolist(), strict=False)
        ]
        sizes = np.fromiter(map(len, links), np.int64, len(links)) // 8
        pairs, index = np.unique(np.frombuffer(b"".join(links), np.int64), return_inverse=True)
        linked, upto = taken(index, sizes, place)
        doc = np.repeat(np.arange(len(texts)), upto[before[1:]] - upto[before[:-1]])
        code = (doc * max(1, len(pairs)) + linked)[~unsound[doc]]
        code, times = np.unique(code, return_counts=True)
        doc, linked = np.divmod(code, max(1, len(pairs)))
        used = np.zeros(len(pairs), bool)  # not by unsound documents alone
        used[linked] = True
        return {
            "doc_ids": doc_ids,
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": count,
            "digests": digests,
            "pairs": pairs[used].tobytes(),
            "linked": (np.cumsum(used) - 1)[linked].astype("<u4").tobytes(),
            "times": times.astype("<u4").tobytes(),
            "per_doc": np.bincount(doc, minlength=len(texts)),
        }


@cache
def _aligner(first: str, second: str) -> Aligner:
    return Aligner(first, second)


_BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_a", pa.list_(pa.int64())),
        ("n_b", pa.list_(pa.int64())),
        ("n_groups", pa.list_(pa.int64())),
        ("digests", pa.list_(pa.string())),
        ("pairs", pa.binary()),
        ("linked", pa.binary()),
        ("times", pa.binary()),
        ("per_doc", pa.list_(pa.int64())),
    ]
)
_BLOCK_DDL = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>,"
    " digests array<string>, pairs binary, linked binary, times binary, per_doc array<long>"
)


def _row(schema: pa.Schema, **values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([values[field.name]], field.type) for field in schema], schema=schema
    )


def _short_blocks(docs: DataFrame, first: str, second: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for piece in slices(batches, "text"):
            columns = (piece.column(name).to_pylist() for name in ("doc_id", "text"))
            yield _row(_BLOCK, block=number, **_aligner(first, second).block(*columns))
            number += 1

    return docs.mapInArrow(run, _BLOCK_DDL)


_RANGE = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("part", pa.int32()),
        ("parts", pa.int32()),
        ("begin", pa.int64()),
        ("first", pa.int64()),
        ("last", pa.int64()),
        ("text", pa.binary()),
    ]
)


def ranges(text: bytes, starts: np.ndarray, chunk: int) -> list[tuple[int, int, int, int]]:
    """Byte ranges of a text: (begin of its first word, first, last, end of its last word).

    A range ends after every `chunk` bytes, wherever that is. The words on
    either edge belong to both neighbours, which encode them whole and keep
    the tokens that end in their own range. Only where a word is longer than a
    range, which thus could not be encoded apart, does the range go up to its end.
    """
    bounds = np.r_[starts, len(text)]
    edges = [0]
    while edges[-1] < len(text):
        edge = edges[-1] + chunk
        if edge < len(text):
            i = int(np.searchsorted(bounds, edge))  # the word that ends at the edge or behind it
            edge = int(bounds[i]) if bounds[i] - bounds[i - 1] > chunk else edge
        edges.append(min(edge, len(text)))
    out = []
    for first, last in zip(edges, edges[1:], strict=False):
        begin = int(bounds[np.searchsorted(bounds, first, "right") - 1])
        end = int(bounds[np.searchsorted(bounds, last)])
        out.append((begin, first, last, end))
    return out


def _cut(docs: DataFrame, first: str, second: str, chunk: int) -> DataFrame:
    """Long texts as rows of one byte range each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            for row, doc_id, text in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                text = b" " + text
                starts = _aligner(first, second).starts(text, np.array([0]))
                found = ranges(text, starts, chunk)
                for part, (begin, low, high, end) in enumerate(found):
                    yield _row(
                        _RANGE,
                        row=row,
                        doc_id=doc_id,
                        part=part,
                        parts=len(found),
                        begin=begin,
                        first=low,
                        last=high,
                        text=text[begin:end],
                    )

    ddl = "row long, doc_id long, part int, parts int, begin long, first long, last long, text binary"
    return docs.mapInArrow(run, ddl)


_ARRAYS = [f"{side}_{name}" for side in ("prefix", "suffix") for name in Tokens._fields]
_FRAGMENT = pa.schema(
    [
        *list(_RANGE)[:4],
        ("sound", pa.bool_()),
        ("cut", pa.bool_()),
        *((name, pa.binary()) for name in _ARRAYS),
        ("text", pa.binary()),
        *((name, pa.int64()) for name in ("count", "n_a", "n_b")),
        ("pairs", pa.binary()),
        ("times", pa.binary()),
    ]
)
_FRAGMENT_DDL = (
    "row long, doc_id long, part int, parts int, sound boolean, cut boolean, "
    + ", ".join(f"{name} binary" for name in _ARRAYS)
    + ", text binary, count long, n_a long, n_b long, pairs binary, times binary"
)


def _packed(found: Fragment) -> dict:
    sides = [array.tobytes() for side in (found.prefix, found.suffix) for array in side]
    groups = found.groups._asdict()
    groups |= {name: groups[name].tobytes() for name in ("pairs", "times")}
    return {"cut": found.cut, **dict(zip(_ARRAYS, sides, strict=True)), **groups}


def _unpacked(row: dict) -> Fragment:
    kinds = (np.uint32, np.int64) * 4
    arrays = [np.frombuffer(row[name], kind) for name, kind in zip(_ARRAYS, kinds, strict=True)]
    numbers = (np.frombuffer(row[name], np.int64) for name in ("pairs", "times"))
    groups = Groups(row["text"], row["count"], row["n_a"], row["n_b"], *numbers)
    return Fragment(row["cut"], Tokens(*arrays[:4]), groups, Tokens(*arrays[4:]))


def _fragments(parts: DataFrame, first: str, second: str) -> DataFrame:
    """Each byte range encoded and aligned on its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(first, second)
        for batch in batches:
            for row in batch.to_pylist():
                text = row["text"]
                starts = aligner.starts(text, np.array([0]))
                words, place = distinct_parts(text, starts, np.r_[starts[1:], len(text)])
                a, b = (spread(ids, place, np.array([0, len(place)]))[0] for ids in aligner.ids(words))
                sound = aligner.bytes_of(b) == text
                found = Fragment()
                if sound:
                    tokens = aligner.tokens(a, b, row["begin"])
                    found = fragment(tokens.within(row["first"], row["last"]))
                keys = {name: row[name] for name in ("row", "doc_id", "part", "parts")}
                yield _row(_FRAGMENT, sound=sound, **keys, **_packed(found))

    return parts.mapInArrow(run, _FRAGMENT_DDL)


def _composed(fragments: DataFrame) -> DataFrame:
    """One level of the tree: every `FAN` neighbours as one fragment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, kept, found, sound = None, None, Fragment(), True
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                group = row["row"], row["part"] // FAN
                if group != key:
                    if key is not None:
                        yield _row(_FRAGMENT, **kept, sound=sound, **_packed(found))
                    key, found, sound = group, Fragment(), True
                    kept = {
                        "row": row["row"],
                        "doc_id": row["doc_id"],
                        "part": group[1],
                        "parts": -(-row["parts"] // FAN),
                    }
                found, sound = found.and_then(_unpacked(row)), sound and row["sound"]
        if key is not None:
            yield _row(_FRAGMENT, **kept, sound=sound, **_packed(found))

    dealt = fragments.repartition("row", F.expr(f"part div {FAN}"))
    return dealt.sortWithinPartitions("row", "part").mapInArrow(run, _FRAGMENT_DDL)


def _long_blocks(docs: DataFrame, first: str, second: str, chunk: int) -> DataFrame | None:
    """Long documents, each as a block, by a tree over the fragments of their ranges; None without any."""
    spark = docs.sparkSession
    parts = staged(_cut(docs, first, second, chunk), "ranges")
    most = parts.agg(F.max("parts")).first()[0]
    if most is None:
        return None
    # By range, not by document: the ranges of one text go to different tasks.
    dealt = parts.repartition(shuffle_parts(spark), "row", "part")
    level = staged(_fragments(dealt, first, second), "fragments")
    trees = level.where("parts = 1")
    while most > 1:
        most = -(-most // FAN)
        level = staged(_composed(level.where("parts > 1")), "fragments")
        trees = trees.unionByName(level.where("parts = 1"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                groups = _unpacked(row).whole() if row["sound"] else Groups()
                linked = np.arange(len(groups.pairs), dtype="<u4")
                yield _row(
                    _BLOCK,
                    block=~row["row"],
                    doc_ids=[row["doc_id"]],
                    n_a=[groups.n_a],
                    n_b=[groups.n_b],
                    n_groups=[groups.count],
                    digests=[sha256(groups.text).hexdigest() if groups.count else ""],
                    pairs=groups.pairs.tobytes(),
                    linked=linked.tobytes(),
                    times=groups.times.astype("<u4").tobytes(),
                    per_doc=[len(linked)],
                )

    return trees.mapInArrow(run, _BLOCK_DDL)


def _pairs(blocks: DataFrame) -> DataFrame:
    """(block, pair, docs): how many documents of a block hold a pair linked."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        blocks, pairs, docs = [], [], []
        for block, keys, linked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pairs.append(np.frombuffer(keys, np.int64))
            docs.append(np.bincount(np.frombuffer(linked, "<u4"), minlength=len(pairs[-1])))
            blocks.append(np.full(len(pairs[-1]), block))
        arrays = [pa.array(np.concatenate(x).astype(np.int64)) for x in (blocks, pairs, docs)]
        return pa.RecordBatch.from_arrays(arrays, ["block", "pair", "docs"])

    narrow = blocks.select("block", "pairs", "linked")
    return map_slices(narrow, run, "block long, pair long, docs long", "linked")


def _scored(key, known: pa.Table, blocks: pa.Table) -> pa.Table:
    """The documents of a block, with the corpus-wide counts of its pairs."""
    row = blocks.to_pylist()[0]
    pairs, counts, best = (known.column(name).to_numpy() for name in ("pair", "count", "best"))
    by = np.argsort(pairs)
    counts, best = counts[by], best[by]
    linked, times = (np.frombuffer(row[name], "<u4").astype(np.int64) for name in ("linked", "times"))
    bounds = np.cumsum([0, *row["per_doc"]])

    def summed(values: np.ndarray) -> np.ndarray:
        upto = np.r_[0, np.cumsum(values)]
        return upto[bounds[1:]] - upto[bounds[:-1]]

    return pa.table(
        {
            "doc_id": pa.array(row["doc_ids"], pa.int64()),
            "n_a": pa.array(row["n_a"], pa.int64()),
            "n_b": pa.array(row["n_b"], pa.int64()),
            "n_groups": pa.array(row["n_groups"], pa.int64()),
            "n_links": pa.array(summed(times), pa.int64()),
            "n_best": pa.array(summed(times * best[linked]), pa.int64()),
            "count_sum": pa.array(summed(times * counts[linked]), pa.int64()),
            "groups_sha256": pa.array(row["digests"], pa.string()),
        }
    )


def link_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): in how many documents two ids are linked, and whether the first is with no other more often."""
    counts = staged(_pairs(blocks).groupBy("pair").agg(F.sum("docs").alias("count")), "counts")
    first = F.shiftright("pair", _ID)
    most = counts.groupBy(first.alias("a")).agg(F.max("count").alias("most"))
    return counts.join(most, first == F.col("a")).select(
        "pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best")
    )


def align_tokens(docs: DataFrame, first: str, second: str, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of `docs`.

    `first` is a byte-level BPE file of the tokenizers library that encodes a
    space and the text, `second` a sentencepiece BPE file that adds a space to
    the text itself; every executor can open both. Names of special tokens in
    a text are ordinary text. Offsets where tokens of both sides end cut the
    tokens into groups; tokens whose bytes overlap are linked. A pair of ids
    counts the documents that hold it linked; `n_best` are the links whose
    count no other pair of their first id exceeds, `count_sum` adds the counts
    of all links. Null and empty texts, and those that the second tokenizer
    does not give back byte by byte, have no tokens: zeros and an empty digest.

    Texts of up to `chunk` bytes are aligned in blocks. Longer ones are cut
    into byte ranges, which tasks encode and align apart; a tree composes the
    fragments. Blocks ask for the counts of their own different pairs, so no
    list of all pairs is broadcast or collected.

    Repeated rows are returned as often as they come, and each counts as a
    document; only `doc_id` and `text` are read, whatever other columns are
    called; an empty table gives no rows.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    size = F.octet_length("text")
    blocks = staged(_short_blocks(source.where(size <= chunk), first, second), "blocks")
    numbered = source.where(size > chunk).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text"
    )
    long = _long_blocks(numbered, first, second, chunk)
    if long is not None:
        blocks = blocks.unionByName(staged(long, "blocks"))
    asked = _pairs(blocks).select("block", "pair")
    known = asked.join(link_counts(blocks), "pair").select("block", "pair", "count", "best")
    together = known.groupBy("block").cogroup(blocks.groupBy("block"))
    ddl = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long,"
        " count_sum long, groups_sha256 string"
    )
    return together.applyInArrow(_scored, ddl)
