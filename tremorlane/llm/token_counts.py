"""Token counts of a sentencepiece BPE model by rank-synchronous array merging."""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlane.llm.common import Remembered, map_slices, utf8

MARK = "▁"  # sentencepiece's sign for a space
LIMIT = 4096
CACHED = 400_000  # pre-tokens a worker remembers between slices
_WORD, _OTHER = r"[^\W_]", rf"(?:[^\w{MARK}]|_)"
_MIXED = f"{_WORD}{_OTHER}|{_OTHER}{_WORD}"
_NEVER = np.iinfo(np.int32).max


class PieceCounter:
    """Counts the tokens of texts as the library would give them.

    Pre-tokens are parts of a text between which no piece of the vocabulary
    reaches: they begin at runs of space marks and, unless a piece mixes the
    two, where letters or digits meet other characters. The different
    pre-tokens of a slice are held as one ragged array.
    """

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        library, size = self.library, self.library.vocab_size()
        if any(library.is_unused(i) for i in range(size)):
            raise ValueError(f"{path}: unused pieces are not supported")
        kinds = ("is_unknown", "is_control", "is_byte")
        special = {i for i in range(size) if any(getattr(library, kind)(i) for kind in kinds)}
        self.byte_fallback = any(library.is_byte(i) for i in range(size))
        pieces = {library.id_to_piece(i): i for i in range(size) if i not in special}
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError(f"{path}: pieces reach across words")
        if any(re.search(_MIXED, piece) for piece in pieces):
            self.pattern = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        else:
            self.pattern = re.compile(f"{MARK}*(?:{_WORD}+|{_OTHER}+)|{MARK}+")

        # A symbol is a character or a piece; characters that are no piece come after the pieces.
        self.symbols = dict(pieces)
        for piece in pieces:
            for letter in piece:
                self.symbols.setdefault(letter, size + len(self.symbols))
        # By code point: the symbol, -1 where the vocabulary has none, and the tokens it ends as.
        code = np.arange(0x110000)
        steps = (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
        self.wide_of = 1 + steps * self.byte_fallback
        self.symbol_of = np.full(len(code), -1, np.int64)
        self.width = np.ones(max(self.symbols.values(), default=0) + 1, np.int64)
        for symbol, number in self.symbols.items():
            if len(symbol) == 1:
                self.symbol_of[ord(symbol)] = number
                if symbol in pieces:
                    self.wide_of[ord(symbol)] = 1
                self.width[number] = self.wide_of[ord(symbol)]

        scores = [library.get_score(i) for i in range(size)]
        rank_of = {score: rank for rank, score in enumerate(sorted(set(scores), reverse=True))}
        pairs = {}
        for piece, number in pieces.items():
            for i in range(1, len(piece)):
                left, right = self.symbols.get(piece[:i]), self.symbols.get(piece[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (rank_of[scores[number]], number)
        self.keys = np.array(sorted(pairs), np.int64)
        ordered = [pairs[key] for key in self.keys.tolist()]
        # A last entry stands for pairs that never merge.
        self.ranks = np.array([rank for rank, _ in ordered] + [_NEVER], np.int32)
        self.merged = np.array([number for _, number in ordered] + [-1], np.int64)
        self.known = Remembered(CACHED)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Entry of each pair of symbols in the merge table."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        missing = self.keys[at] != key if len(self.keys) else np.ones(len(key), bool)
        return np.where(missing, len(self.keys), at)

    def _symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols and their output widths, flat over all words, and each symbol's word."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        word = np.repeat(np.arange(len(words)), [len(x) for x in words])
        return self.symbol_of[codes], self.wide_of[codes], word

    def merge(self, words: list[str]) -> np.ndarray:
        """Number of tokens of each word; all words advance together.

        In a round every word applies its lowest-ranked pair, at all its
        places from left to right. Where one of these merges makes a pair that
        ranks no later than itself, the word applies only the first place, as
        the new pair then comes before the other places.
        """
        counts = np.zeros(len(words), np.int64)
        symbol, wide, word = self._symbols(words)
        if not len(symbol):
            return counts
        entry = np.full(len(symbol), len(self.keys))
        inside = np.flatnonzero((word[1:] == word[:-1]) & (symbol[:-1] >= 0) & (symbol[1:] >= 0))
        entry[inside] = self._find(symbol[inside], symbol[inside + 1])
        while len(symbol):
            rank = self.ranks[entry]
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(symbol)])
            done = lowest == _NEVER
            if done.any():
                counts[word[starts[done]]] = np.add.reduceat(wide, starts)[done]
                stay = np.repeat(~done, sizes)
                symbol, wide, word, entry = symbol[stay], wide[stay], word[stay], entry[stay]
                rank, lowest, sizes = rank[stay], lowest[~done], sizes[~done]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, sizes))
            run = np.r_[True, np.diff(at) != 1]  # overlapping places: every other one
            begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
            new = self.merged[entry[at]]

            early = np.zeros(len(at), bool)
            for other, left in ((at - 1, True), (at + 2, False)):
                fits = (other >= 0) & (other < len(symbol))
                fits[fits] = (word[other[fits]] == word[at[fits]]) & (symbol[other[fits]] >= 0)
                near = symbol[other[fits]]
                found = self._find(near, new[fits]) if left else self._find(new[fits], near)
                early[fits] |= self.ranks[found] <= rank[at[fits]]
            twins = np.flatnonzero(np.diff(at) == 2)
            found = self._find(new[twins], new[twins + 1])
            early[twins] |= self.ranks[found] <= rank[at[twins]]
            if early.any():
                careful = np.isin(word[at], word[at[early]])
                first = np.r_[True, word[at[1:]] != word[at[:-1]]]
                at, new = at[~careful | first], new[~careful | first]

            symbol[at], wide[at] = new, self.width[new]
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            moved = np.cumsum(stay) - 1
            symbol, wide, word, entry = symbol[stay], wide[stay], word[stay], entry[stay]
            touched = moved[at]
            changed = np.zeros(len(symbol), bool)
            changed[touched] = changed[np.maximum(touched - 1, 0)] = True
            touched = np.flatnonzero(changed)
            entry[touched] = len(self.keys)
            touched = touched[touched + 1 < len(symbol)]
            fits = (word[touched] == word[touched + 1]) & (symbol[touched] >= 0)
            touched = touched[fits & (symbol[touched + 1] >= 0)]
            entry[touched] = self._find(symbol[touched], symbol[touched + 1])
        return counts

    def count(self, texts: list[str]) -> list[int]:
        parts = [self.pattern.findall(text) for text in self.library.normalize(texts)]
        ordered = self.known.absent(set().union(*parts))
        self.known.update(zip(ordered, self.merge(ordered).tolist(), strict=True))
        return [sum(map(self.known.__getitem__, words)) for words in parts]


@cache
def _counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of `docs`.

    `model` is a sentencepiece BPE file that every executor can open. Counts
    are the library's, without begin or end tokens; names of control tokens
    inside a text are ordinary text, as is its default. Null and empty texts
    have no bytes and no tokens. Repeated rows are returned as often as they
    come; only `doc_id` and `text` are read; an empty table gives no rows.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        counts = _counter(model).count([text.decode() for text in texts])
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(map(len, texts), pa.int64()),
                pa.array(counts, pa.int64()),
            ],
            ["doc_id", "n_bytes", "n_tokens"],
        )

    source = docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text"))
    counted = map_slices(source, run, "doc_id long, n_bytes long, n_tokens long", "text")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
