"""BPE by forced boundaries: certain cuts first, then every fragment on its own."""

from __future__ import annotations

import json
import re
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import accumulate
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tremorlane.llm.common import Remembered, map_slices, utf8
from tremorlane.llm.ragged import distinct_parts, spread

CACHED = 250_000  # words a worker remembers between slices, and as many fragments
_FEW = 48  # bytes of fragments that are merged in step; longer ones would need too many rounds
WHITE = b" \t\n\v\f\r"

# Fixed value: how the byte-level pre-tokenizer parts a text.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable character that a byte-level vocabulary writes for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(shown)]
    letters = {chr(byte): byte for byte in shown}
    return letters | {chr(256 + i): byte for i, byte in enumerate(others)}


def _word_ends() -> tuple[np.ndarray, np.ndarray]:
    """By left and right byte, where a word may end: after ASCII, and after a wide character."""
    kind = np.zeros(256, int)  # control characters and the bytes of wide characters
    for byte in range(0x21, 0x7F):
        kind[byte] = 1 if chr(byte).isalpha() else 2 if chr(byte).isdigit() else 3
    kind[list(WHITE)] = 4
    visible = (kind > 0) & (kind < 4)
    ends = visible[:, None] & (kind > 0)[None, :] & (kind[:, None] != kind[None, :])
    ends[ord("'"), kind == 1] = False  # a contraction
    wide = np.zeros((256, 256), bool)
    wide[0x80:0xC0, kind == 4] = True
    return ends, wide


class BoundaryBpe:
    """Encodes as a byte-level BPE file of the tokenizers library says.

    Two bytes that never stand side by side inside any token of the vocabulary
    can never be merged, wherever they meet: the place between them is a cut
    that needs no look at the rest of the text. Where the kind of the characters
    changes, such a place parts the pre-tokenizer's work as well, so texts come
    apart into words there, found for a whole slice with one lookup per byte;
    the others part the pre-tokens of a word into fragments. Different words
    and fragments are encoded once.

    `specials=False` takes the names of special tokens in a text as ordinary
    text; otherwise they become their tokens, as the library does.
    """

    def __init__(self, path: str, specials: bool = True, cached: int = CACHED):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self._check(path, told)
        letters = byte_letters()
        self.letters = letters
        vocabulary: dict[str, int] = told["model"]["vocab"]
        added = {token["id"]: token["content"] for token in told["added_tokens"]}
        self.size = 1 + max([*vocabulary.values(), *added])
        self.tokens: list[bytes | None] = [None] * self.size
        self.inside = np.zeros((256, 256), bool)
        for token, number in vocabulary.items():
            if number not in added:
                text = bytes(map(letters.__getitem__, token))
                self.tokens[number] = text
                codes = np.frombuffer(text, np.uint8)
                self.inside[codes[:-1], codes[1:]] = True
        for number, content in added.items():
            self.tokens[number] = content.encode()
        self.of_byte = [-1] * 256
        for letter, byte in letters.items():
            self.of_byte[byte] = vocabulary[letter]

        self.merges: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(told["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            key = vocabulary[left] * self.size + vocabulary[right]
            self.merges[key] = rank, vocabulary[left + right]

        self.never = len(told["model"]["merges"])
        known = sorted((key, *merge) for key, merge in self.merges.items())
        known.append((2**62, 0, 0))  # so that every search ends at a pair
        keys, ranks, results = zip(*known, strict=True)
        self.merge_keys, self.merge_ranks = np.array(keys, np.int64), np.array(ranks, np.int32)
        self.merge_results = np.zeros(self.never, np.int32)
        self.merge_results[self.merge_ranks[:-1]] = results[:-1]

        self.specials = {text.encode(): number for number, text in added.items() if specials}
        names = sorted(map(re.escape, self.specials), key=len, reverse=True)
        self.special = re.compile(b"(%b)" % b"|".join(names)) if names else None
        self.find = regex.compile(PATTERN).findall
        self.pretokens = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        # By left and right byte: whether words come apart there.
        self.ascii_ends, self.wide_ends = _word_ends()
        self.ascii_ends &= ~self.inside
        self.wide_ends &= ~self.inside
        self.words, self.fragments = Remembered(cached), Remembered(cached)

    @staticmethod
    def _check(path: str, told: dict) -> None:
        """Refuse files whose rules this class does not follow."""
        model, first = told["model"], told["pre_tokenizer"] or {}
        odd = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        problems = [
            model["type"] != "BPE",
            any(model.get(name) for name in odd),
            told["normalizer"] is not None,
            first.get("type") != "ByteLevel" or first.get("add_prefix_space"),
            not first.get("use_regex", True),
            (told["decoder"] or {}).get("type") != "ByteLevel",
            any(
                token[name]
                for token in told["added_tokens"]
                for name in ("single_word", "lstrip", "rstrip", "normalized")
            ),
            any(set(WHITE.decode()) & set(token["content"]) for token in told["added_tokens"]),
        ]
        if any(problems):
            raise ValueError(f"{path}: not a plain byte-level BPE file")

    def starts(self, codes: np.ndarray, bounds: np.ndarray, at: bytes = b"") -> np.ndarray:
        """Where words begin in joined texts that begin at `bounds`.

        Besides at the bounds that is where the pre-tokenizer certainly begins
        anew: where ASCII letters, digits, other visible signs and white space
        follow one another, but for what follows white space or an apostrophe,
        and at white space after a character of two bytes beyond U+00BF. `at`
        restricts these places to those of its characters. No rule of the
        pre-tokenizer looks back over such a place, and no token reaches over it.
        """
        left, right = codes[:-1], codes[1:]
        cut = self.ascii_ends[left, right]
        wide = np.flatnonzero(self.wide_ends[left, right])
        lead = codes[wide - 1]
        cut[wide[(wide > 0) & (lead >= 0xC3) & (lead < 0xE0)]] = True
        if at:
            cut &= np.isin(right, list(at))
        begin = np.zeros(len(codes), bool)
        begin[1:] = cut
        begin[bounds[bounds < len(codes)]] = True
        return np.flatnonzero(begin)

    def _merged(self, texts: list[bytes]) -> list[bytes]:
        """Ids of fragments: the least rank first, the leftmost of equal ranks."""
        short = [text for text in texts if len(text) <= _FEW]
        found = dict(zip(short, self._merge_short(short), strict=True)) if short else {}
        for text in texts:
            if len(text) > _FEW:
                symbols = self._merge_many(list(map(self.of_byte.__getitem__, text)))
                found[text] = pack(f"<{len(symbols)}I", *symbols)
        return list(map(found.__getitem__, texts))

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; one beyond all ranks for those that never merge."""
        keys = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.merge_keys, keys)
        return np.where(self.merge_keys[at] == keys, self.merge_ranks[at], self.never)

    def _merge_short(self, texts: list[bytes]) -> list[bytes]:
        """Fragments in step: in every round each merges one pair, until it has none left."""
        never = self.never
        out = [b""] * len(texts)
        number = np.arange(len(texts))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        symbols = np.array(self.of_byte, np.int32)[np.frombuffer(b"".join(texts), np.uint8)]
        last = np.zeros(len(symbols), bool)
        last[np.cumsum(sizes) - 1] = True
        ranks = np.full(len(symbols), never, np.int32)
        inner = np.flatnonzero(~last)
        ranks[inner] = self._ranks(symbols[inner], symbols[inner + 1])
        while len(number):
            first = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(ranks, first)
            live = least < never
            keep = np.ones(len(symbols), bool)
            if not live.all():
                keep = np.repeat(live, sizes)
                raw, cuts = symbols[~keep].astype("<u4").tobytes(), 4 * np.cumsum(sizes[~live])
                begin = 0
                for i, end in zip(number[~live].tolist(), cuts.tolist(), strict=True):
                    out[i] = raw[begin:end]
                    begin = end
            at = np.flatnonzero((ranks == np.repeat(least, sizes)) & keep)
            of = np.searchsorted(first, at, "right") - 1
            at = at[np.r_[True, of[1:] != of[:-1]][: len(of)]]  # the leftmost
            symbols[at] = self.merge_results[ranks[at]]
            ranks[at], last[at] = never, last[at + 1]
            keep[at + 1] = False
            changed = np.zeros(len(symbols), bool)
            changed[at] = True
            changed[at[at > first[live]] - 1] = True
            changed &= ~last
            number, sizes = number[live], sizes[live] - 1
            symbols, ranks, last, changed = (side[keep] for side in (symbols, ranks, last, changed))
            at = np.flatnonzero(changed)
            ranks[at] = self._ranks(symbols[at], symbols[at + 1])
        return out

    def _merge_many(self, symbols: list[int]) -> list[int]:
        size, find = self.size, self.merges.get
        pairs = zip(symbols, symbols[1:], strict=False)
        found = [find(left * size + right) for left, right in pairs]
        ranks = [-1 if merge is None else merge[0] for merge in found] + [-1]
        order = [(rank, at) for at, rank in enumerate(ranks) if rank >= 0]
        if order:
            heapify(order)
            after = list(range(1, len(symbols) + 1))
            before = list(range(-1, len(symbols) - 1))
            while order:
                rank, at = heappop(order)
                if ranks[at] != rank:
                    continue
                gone = after[at]
                symbols[at] = find(symbols[at] * size + symbols[gone])[1]
                symbols[gone] = ranks[gone] = -1
                beyond = after[at] = after[gone]
                if beyond < len(symbols):
                    before[beyond] = at
                for left, right in ((at, beyond), (before[at], at)):
                    if left >= 0:
                        ranks[left] = -1
                        if right < len(symbols):
                            merge = find(symbols[left] * size + symbols[right])
                            if merge is not None:
                                ranks[left] = merge[0]
                                heappush(order, (merge[0], left))
            symbols = [symbol for symbol in symbols if symbol >= 0]
        return symbols

    def _bounds(self, word: bytes) -> list[int]:
        """Where the pre-tokens of a word begin, but for the first."""
        text = word.decode()
        letters = text.removeprefix(" ")
        if letters.isalpha() and max(letters) < "\u0530":
            return []
        if word.isascii():
            sizes = map(len, self.find(text))
        else:  # character classes as the library has them; a letter of its output is a byte
            sizes = (len(token) for token, _ in self.pretokens(text))
        return list(accumulate(sizes))[:-1]

    def learn(self, words: list[bytes]) -> list[bytes]:
        """Ids of different words, each as little-endian unsigned 32-bit integers.

        New words are parted into pre-tokens, and these where two bytes meet
        that no token holds side by side; different fragments are merged.
        """
        new = []
        for word in self.words.absent(words):
            number = self.specials.get(word)
            if number is None:
                new.append(word)
            else:
                self.words[word] = number.to_bytes(4, "little")
        if new:
            joined = b"".join(new)
            bounds = list(accumulate(map(len, new), initial=0))
            codes = np.frombuffer(joined, np.uint8)
            begin = np.zeros(len(codes), bool)
            begin[1:] = ~self.inside[codes[:-1], codes[1:]]
            begin[bounds[:-1]] = True
            inner = [at + i for word, at in zip(new, bounds, strict=False) for i in self._bounds(word)]
            begin[inner] = True
            starts = np.flatnonzero(begin)
            fragments, place = distinct_parts(joined, starts, np.r_[starts[1:], len(joined)])
            absent = self.fragments.absent(fragments)
            self.fragments.update(zip(absent, self._merged(absent), strict=True))
            ids = list(map(self.fragments.__getitem__, fragments))
            found = spread(ids, place, np.searchsorted(starts, bounds))
            self.words.update(zip(new, found, strict=True))
        return list(map(self.words.__getitem__, words))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text as little-endian unsigned 32-bit integers."""
        units, units_before, names = [], [0], []
        for text in texts:
            if self.special and self.special.search(text):
                parts = self.special.split(text)  # every other one is a special token
                names += range(len(units) + 1, len(units) + len(parts), 2)
                units += parts
            else:
                units.append(text)
            units_before.append(len(units))
        joined = b"".join(units)
        if not joined:
            return [b""] * len(texts)
        bounds = np.cumsum([0, *map(len, units)])
        starts = self.starts(np.frombuffer(joined, np.uint8), bounds)
        if names:  # a name is one word
            unit = np.searchsorted(bounds, starts, "right") - 1
            starts = starts[~np.isin(unit, names) | np.isin(starts, bounds)]
        words, place = distinct_parts(joined, starts, np.r_[starts[1:], len(joined)])
        before = np.searchsorted(starts, bounds[units_before])
        return spread(self.learn(words), place, before)

    def decode(self, ids: bytes) -> bytes:
        """The text that ids stand for; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode(errors="replace").encode()


@cache
def _coder(path: str) -> BoundaryBpe:
    return BoundaryBpe(path)


def boundary_round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, decoded) for every row of `docs`.

    `tokenizer` is a byte-level BPE file of the tokenizers library that every
    executor can open; one with other rules is refused. `ids` are
    little-endian unsigned 32-bit integers without added begin or end tokens,
    `decoded` the UTF-8 text they stand for, special tokens included. Null and
    empty texts have no ids. Repeated rows are returned as often as they come;
    only `doc_id` and `text` are read, whatever other columns are called; an
    empty table gives no rows. Nothing is shuffled.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = _coder(tokenizer)
        ids = coder.encode(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(ids, pa.binary()),
                pa.array(map(coder.decode, ids), pa.binary()),
            ],
            ["doc_id", "ids", "decoded"],
        )

    source = docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text"))
    return map_slices(source, run, "doc_id long, ids binary, decoded binary", "text")


def boundary_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the round trip of every row."""
    return boundary_round_trip(docs, tokenizer).select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
