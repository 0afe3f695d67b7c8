"""Alignment of two tokenizers against the libraries and all pairs of tokens."""

from __future__ import annotations

import random
from bisect import bisect_left
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.test_tokens import LETTERS, random_texts
from tremorlane.llm.alignment import (
    Aligner,
    Fragment,
    Tokens,
    align_tokens,
    closed,
    fragment,
    ranges,
)
from tremorlane.llm.forced_boundary import byte_letters
from tremorlane.llm.queries import BYTE_PAIRS, PIECES

FIRST, SECOND = public_tokenizers.path(BYTE_PAIRS), public_tokenizers.path(PIECES)


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(FIRST)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=SECOND)
        self.letters = byte_letters()

    def tokens(self, text):
        """(id, first byte, end) of both sides, or none."""
        if not text:
            return [], []
        encoded = self.a.encode(" " + text, add_special_tokens=False)
        ids = self.b.encode(text)
        a = [(i, bytes(self.letters[c] for c in t)) for i, t in zip(encoded.ids, encoded.tokens)]
        b = []
        for i in ids:
            piece = self.b.id_to_piece(i)
            is_byte = self.b.is_byte(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            return [], []
        out = []
        for side in (a, b):
            at, placed = 0, []
            for i, raw in side:
                placed.append((i, at, at + len(raw)))
                at += len(raw)
            out.append(placed)
        return out

    def document(self, text):
        a, b = self.tokens(text)
        common = sorted({end for *_, end in a} & {end for *_, end in b})
        group_of = {}
        for side in (a, b):
            for i, _, end in side:
                at = bisect_left(common, end)
                group_of.setdefault((at, side is b), []).append(str(i))
        groups = [
            f"{','.join(group_of[n, False])}|{','.join(group_of[n, True])}" for n in range(len(common))
        ]
        links, j = [], 0
        for i, low, high in a:
            while j and b[j - 1][2] > low:
                j -= 1
            while j < len(b) and b[j][1] < high:
                if b[j][2] > low:
                    links.append((i, b[j][0]))
                j += 1
        return len(a), len(b), groups, links

    def table(self, rows):
        found = [(doc_id, *self.document(text)) for doc_id, text in rows]
        counts = Counter(pair for *_, links in found for pair in set(links))
        best = {}
        for (a, _), n in counts.items():
            best[a] = max(n, best.get(a, 0))
        out = []
        for doc_id, n_a, n_b, groups, links in found:
            n_best = sum(counts[pair] == best[pair[0]] for pair in links)
            digest = sha256(";".join(groups).encode()).hexdigest() if groups else ""
            total = sum(counts[pair] for pair in links)
            out.append((doc_id or -1, n_a, n_b, len(groups), len(links), n_best, total, digest))
        return sorted(out)


@pytest.fixture(scope="module")
def plain():
    return Plain()


def found(table):
    return sorted((row[0] or -1, *row[1:]) for row in table.collect())


@pytest.mark.parametrize("letters", [LETTERS, "abcdef gh.,'", "s'!  §  x\n\t\x1c\x85éд日😀", "0123 abc"])
def test_words_are_aligned_as_whole_texts(plain, letters):
    aligner = Aligner(FIRST, SECOND)
    texts = [text for text in random_texts(21, letters, 600)]
    block = aligner.block(list(range(len(texts))), [text.encode() for text in texts])
    for i, text in enumerate(texts):
        n_a, n_b, groups, links = plain.document(text)
        digest = sha256(";".join(groups).encode()).hexdigest() if groups else ""
        assert (n_a, n_b, len(groups)) == tuple(block[k][i] for k in ("n_a", "n_b", "n_groups")), text
        assert digest == block["digests"][i]
    pairs = np.frombuffer(block["pairs"], np.int64).tolist()
    linked = [pairs[i] for i in np.frombuffer(block["linked"], "<u4").tolist()]
    times = np.frombuffer(block["times"], "<u4").tolist()
    at = np.cumsum([0, *block["per_doc"]]).tolist()
    for i, text in enumerate(texts):
        mine = dict(zip(linked[at[i] : at[i + 1]], times[at[i] : at[i + 1]], strict=True))
        links = plain.document(text)[3]
        assert mine == Counter(a << 32 | b for a, b in links)


def random_tokens(rng, size):
    def ends():
        inner = rng.choice(np.arange(1, size), int(rng.integers(1, size // 2)), replace=False)
        return np.sort(np.r_[inner, size]).astype(np.int64)

    a, b = ends(), ends()
    ids = (rng.integers(0, 9, len(side)).astype(np.uint32) for side in (a, b))
    return Tokens(next(ids), a, next(ids), b)


def same(x: Fragment, y: Fragment) -> bool:
    def flat(value):
        if isinstance(value, tuple):
            return [item for part in value for item in flat(part)]
        return [value.tolist() if isinstance(value, np.ndarray) else value]

    return flat(x) == flat(y)


def test_composition_is_associative_and_neutral():
    rng = np.random.default_rng(5)
    for _ in range(200):
        size = int(rng.integers(8, 90))
        tokens = random_tokens(rng, size)
        cuts = np.sort(rng.choice(np.arange(1, size), 4, replace=False)).tolist()
        bounds = [0, *cuts, size]
        parts = [fragment(tokens.within(a, b)) for a, b in zip(bounds, bounds[1:], strict=False)]
        left = parts[0]
        for part in parts[1:]:
            left = left.and_then(part)
        right = parts[-1]
        for part in reversed(parts[:-1]):
            right = part.and_then(right)
        middle = parts[0].and_then(parts[1].and_then(parts[2])).and_then(parts[3].and_then(parts[4]))
        assert same(left, right) and same(left, middle)
        assert same(Fragment().and_then(left), left) and same(left.and_then(Fragment()), left)
        assert same(Fragment(groups=left.whole()), Fragment(groups=closed(tokens)))


def test_ranges_cover_a_text():
    aligner = Aligner(FIRST, SECOND)
    text = (" " + "word " * 50 + "x" * 300 + " end of it" * 9).encode()
    starts = aligner.starts(text, np.array([0]))
    found = ranges(text, starts, 41)
    assert [low for _, low, _, _ in found] == [0, *(high for _, _, high, _ in found[:-1])]
    assert found[-1][2] == len(text)
    for begin, low, high, end in found:
        assert begin <= low < high <= end and begin in starts
        assert end - begin <= 3 * 41 or b"x" * 300 in text[begin:end]
    assert any(high not in {*starts.tolist(), len(text)} for _, _, high, _ in found)


@pytest.mark.parametrize("chunk", [7, 50, 1 << 16])
def test_table(plain, docs_of, odd_rows, chunk):
    random.seed(chunk)
    rows = [(i if i != 6 else 60, text and text[:4000]) for i, text in odd_rows]
    rows += [(i + 100, text[:300]) for i, text in enumerate(random_texts(4, LETTERS, 30))]
    rows += [(999, "has the mark ▁ itself, " * 20), (1000, "日本語の文章" * 40), (1001, "z" * 700)]
    assert found(align_tokens(docs_of(rows), FIRST, SECOND, chunk)) == plain.table(rows)


def test_long_texts_over_several_levels(plain, docs_of):
    rows = [(1, " ".join(f"t{i * 7919 % 1009}é{i % 13}" for i in range(12_000))), (2, "short"), (2, "")]
    assert found(align_tokens(docs_of(rows), FIRST, SECOND, 1024)) == plain.table(rows)


def test_no_documents(no_docs):
    assert align_tokens(no_docs, FIRST, SECOND).count() == 0
