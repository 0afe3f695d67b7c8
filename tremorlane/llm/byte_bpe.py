"""Byte-level BPE by corpus-level merge replay, and its decoding."""

from __future__ import annotations

import base64
from functools import cache
from heapq import heappop, heappush
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlane.llm.common import Remembered, map_slices, utf8

CACHED = 300_000  # words a worker remembers between slices
_FEW = 24  # places of a pair that are quicker to merge in turn
SLICE = 4 << 20  # bytes of text whose different words are merged together


class ByteBpe:
    """A rank file with the pattern that cuts texts into words."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            fields = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in fields}
        self.find = regex.compile(pattern).findall
        self.letters = np.array([self.ranks[bytes([i])] for i in range(256)])
        #: Rank of each pair of bytes, the size of the vocabulary where it never merges.
        self.size = max(self.ranks.values()) + 1
        self.tokens: list[bytes | None] = [None] * self.size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.merges: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    self.merges[left * self.size + right] = rank
        left, right = np.divmod(np.array(list(self.merges), np.int64), self.size)
        ranks = np.array(list(self.merges.values()), np.int64)
        self._by_left = self._sides(left, right, ranks)
        self._by_right = self._sides(right, left, ranks)
        self._table = np.full(self.size + 1, self.size)  # its last entry is for no symbol
        pairs = [
            self.ranks.get(bytes([a, b]), self.size) for a in range(256) for b in range(256)
        ]
        self.pairs = np.array(pairs).reshape(256, 256)
        self.known = Remembered(CACHED)

    def _sides(self, one: np.ndarray, other: np.ndarray, ranks: np.ndarray) -> tuple:
        """The merges by one of their symbols: where its own begin, the other symbols, the ranks."""
        by = np.argsort(one, kind="stable")
        return np.searchsorted(one[by], np.arange(self.size + 1)), other[by], ranks[by]

    def _looked_up(self, sides: tuple, symbol: int, others: np.ndarray) -> np.ndarray:
        begin, known, ranks = sides
        own = slice(begin[symbol], begin[symbol + 1])
        self._table[known[own]] = ranks[own]
        found = self._table[others]
        self._table[known[own]] = self.size
        return found

    def with_left(self, left: int, others: np.ndarray) -> np.ndarray:
        """Ranks of the pairs of one left symbol with others; -1 stands for none."""
        return self._looked_up(self._by_left, left, others)

    def with_right(self, right: int, others: np.ndarray) -> np.ndarray:
        """Ranks of the pairs of others with one right symbol."""
        return self._looked_up(self._by_right, right, others)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers.

        The words, none of them empty, lie in one sequence of symbols. An
        index leads from each mergeable pair, by its rank, to its places; the
        least rank is taken with all its places, and only the pairs on either
        side of a merge are looked up again.
        """
        if not words:
            return []
        ends = list(accumulate(map(len, words)))
        line = _Line(self, np.frombuffer(b"".join(words), np.uint8), np.array([0, *ends]))
        while line.order:
            rank = heappop(line.order)
            at = np.unique(np.concatenate(line.places.pop(rank)))
            at = at[line.current[at] == rank]
            if len(at) <= _FEW or not line.merge_all(rank, at):
                line.merge_in_turn(rank, at.tolist())
        alive = line.symbol >= 0
        upto = np.r_[0, np.cumsum(alive)][[0, *ends]].tolist()
        ids = line.symbol[alive].astype("<u4").tobytes()
        return [ids[4 * a : 4 * b] for a, b in zip(upto, upto[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; different words of all texts are merged together, once."""
        parts = [self.find(text) for text in texts]
        open_words = []
        for word in self.known.absent(set().union(*parts)):
            whole = self.ranks.get(word.encode())
            if whole is None:
                open_words.append(word)
            else:  # a word that is a token is never merged
                self.known[word] = whole.to_bytes(4, "little")
        merged = self.replay([word.encode() for word in open_words])
        self.known.update(zip(open_words, merged, strict=True))
        return [b"".join(map(self.known.__getitem__, words)) for words in parts]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Line:
    """Symbols of many words, linked to their neighbours, and the index of their pairs."""

    def __init__(self, coder: ByteBpe, codes: np.ndarray, bounds: np.ndarray):
        self.coder, self.none = coder, coder.size
        total = len(codes)
        self.symbol = coder.letters[codes]
        self.following, self.previous = np.arange(1, total + 2), np.arange(-1, total)
        self.following[bounds - 1] = self.previous[bounds] = -1
        #: Rank of the pair that begins at a place, `none` where there is none to merge.
        self.current = np.full(total, self.none)
        self.current[:-1] = coder.pairs[codes[:-1], codes[1:]]
        self.current[bounds[1:] - 1] = self.none
        self.places: dict[int, list[np.ndarray]] = {}
        self.order: list[int] = []
        at = np.flatnonzero(self.current < self.none)
        self._enter(self.current[at], at)

    def _enter(self, ranks: np.ndarray, at: np.ndarray) -> None:
        by = np.argsort(ranks, kind="stable")
        ranks, at = ranks[by], at[by]
        heads = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]]) if len(at) else []
        tails = [*heads[1:], len(at)]
        for rank, a, b in zip(ranks[heads].tolist() if len(at) else [], heads, tails, strict=False):
            if rank in self.places:
                self.places[rank].append(at[a:b])
            else:
                self.places[rank] = [at[a:b]]
                heappush(self.order, rank)

    def merge_all(self, rank: int, at: np.ndarray) -> bool:
        """Merge a pair at all its places at once; False where they must be taken in turn.

        That is where places overlap, or where a merge makes a pair of a lower
        rank, which has to come before the places that follow.
        """
        gone = self.following[at]
        if (gone[:-1] == at[1:]).any():
            return False
        beyond, ahead = self.following[gone], self.previous[at]
        right = np.where(beyond >= 0, self.symbol[beyond], -1)
        left = np.where(ahead >= 0, self.symbol[ahead], -1)
        after = self.coder.with_left(rank, right)
        before = self.coder.with_right(rank, left)
        twins = np.flatnonzero(beyond[:-1] == at[1:])  # merges side by side
        before[twins + 1] = self.none
        both = self.coder.merges.get(rank * self.none + rank, self.none)
        if after.min() < rank or before.min() < rank or (len(twins) and both < rank):
            return False
        after[twins] = both
        self.symbol[at], self.symbol[gone], self.current[gone] = rank, -1, self.none
        self.following[at] = beyond
        linked = beyond >= 0
        self.previous[beyond[linked]] = at[linked]
        self.current[at] = after
        linked = ahead >= 0
        linked[twins + 1] = False
        self.current[ahead[linked]] = before[linked]
        new, ready = np.r_[after, before[linked]], np.r_[at, ahead[linked]]
        found = new < self.none
        self._enter(new[found], ready[found])
        return True

    def merge_in_turn(self, rank: int, found: list[int]) -> None:
        """Merge a pair from left to right, as far as no lower rank comes up."""
        symbol, current, find = self.symbol, self.current, self.coder.merges.get
        none = self.none
        for done, at in enumerate(found, 1):
            if current[at] != rank:
                continue
            gone = int(self.following[at])
            beyond, ahead = int(self.following[gone]), int(self.previous[at])
            symbol[at], symbol[gone], current[gone] = rank, -1, none
            self.following[at] = beyond
            after = before = none
            if beyond >= 0:
                self.previous[beyond] = at
                after = find(rank * none + int(symbol[beyond]), none)
            current[at] = after
            if ahead >= 0:
                before = current[ahead] = find(int(symbol[ahead]) * none + rank, none)
            for new, place in ((after, at), (before, ahead)):
                if new < none:
                    if new in self.places:
                        self.places[new].append(np.array([place]))
                    else:
                        self.places[new] = [np.array([place])]
                        heappush(self.order, new)
            if min(after, before) < rank and done < len(found):
                self.places[rank] = [np.array(found[done:])]
                heappush(self.order, rank)
                return


@cache
def _coder(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def bpe_encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids) for every row of `docs`: ids as little-endian 32-bit integers, in one binary.

    `ranks` is a rank file that every executor can open; each match of
    `pattern` is encoded separately, and names of special tokens are ordinary
    text. Null and empty texts have no ids. Repeated rows are returned as
    often as they come; only `doc_id` and `text` are read; an empty table
    gives no rows.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [text.decode() for text in batch.column("text").to_pylist()]
        ids = pa.array(_coder(ranks, pattern).encode(texts), pa.binary())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    source = docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text"))
    return map_slices(source, run, "doc_id long, ids binary", "text", SLICE)


def bpe_decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes that the ids stand for; null ids count as none."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        decode = _coder(ranks, pattern).decode
        texts = pa.array([decode(ids) for ids in batch.column("ids").to_pylist()], pa.binary())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("ids"), texts], ["doc_id", "ids", "decoded"]
        )

    ids = F.coalesce(F.col("ids"), F.lit(b"")).alias("ids")
    source = encoded.select(F.col("doc_id").cast("long"), ids)
    return map_slices(source, run, "doc_id long, ids binary, decoded binary", "ids")


def bpe_round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """`bpe_decode` of `bpe_encode`, in one pass so that a task needs one Python worker."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = _coder(ranks, pattern)
        ids = coder.encode([text.decode() for text in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(ids, pa.binary()),
                pa.array(map(coder.decode, ids), pa.binary()),
            ],
            ["doc_id", "ids", "decoded"],
        )

    source = docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text"))
    return map_slices(source, run, "doc_id long, ids binary, decoded binary", "text", SLICE)


def bpe_digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) of the round trip of every row."""
    return bpe_round_trip(docs, ranks, pattern).select(
        "doc_id",
        "ids",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
