"""Token ids and counts against the libraries themselves."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
import xxhash
from tokenizers import Tokenizer

from tremorlane.llm.byte_bpe import ByteBpe, bpe_decode, bpe_digests, bpe_encode
from tremorlane.llm.queries import BYTE_RANKS, PIECES, WORD_PIECES
from tremorlane.llm.ragged import distinct_words
from tremorlane.llm.token_counts import PieceCounter, token_counts
from tremorlane.llm.token_store import (
    LibraryIds,
    TokenFile,
    stored_token_digest,
    stored_tokens,
    to_bytes,
)

RANKS = public_tokenizers.path(BYTE_RANKS)
WORDS = public_tokenizers.path(WORD_PIECES)
MODEL = public_tokenizers.path(PIECES)
LETTERS = "abcdet hn\n é日.,;01'ß_İΣǄ\x1c\x85 ‍́\t|<>%▁"


def random_texts(seed: int, letters: str = LETTERS, count: int = 1500) -> list[str]:
    random.seed(seed)
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 60))) for _ in range(count)]
    return ["", " ", "   ", "a" * 3000, "ab" * 2000, "<|endoftext|>x", "<s></s><0x0A>", *texts]


@pytest.fixture(scope="module")
def bpe_library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.mark.parametrize("letters", [LETTERS, "aeinort", "ab "])
def test_byte_bpe_is_the_librarys(bpe_library, letters):
    coder = ByteBpe(RANKS, public_tokenizers.PATTERN)
    texts = random_texts(1, letters)
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == bpe_library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_merges_wait_for_a_lower_rank(tmp_path):
    """'ab' may merge twice only if 'aba', which ranks before it, is not made in between."""
    tokens = [bytes([i]) for i in range(256)] + [b"aba", b"ab"]
    path = tmp_path / "ranks"
    path.write_bytes(
        b"\n".join(base64.b64encode(token) + b" %d" % i for i, token in enumerate(tokens))
    )
    coder = ByteBpe(str(path), ".+")
    library = tiktoken.Encoding(
        "t", pat_str=".+", mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={}
    )
    for text in ("abab", "ababab", "abababa", "babab"):
        ids = np.frombuffer(coder.encode([text])[0], "<u4").tolist()
        assert ids == library.encode_ordinary(text)


def test_byte_bpe_table(bpe_library, odd_docs, odd_rows, no_docs):
    pattern = public_tokenizers.PATTERN
    decoded = bpe_decode(bpe_encode(odd_docs, RANKS, pattern), RANKS, pattern).collect()
    assert sorted(bytes(row["decoded"]) for row in decoded) == sorted(
        (text or "").encode() for _, text in odd_rows
    )
    expected = []
    for doc_id, text in odd_rows:
        ids = bpe_library.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        digests = (hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        expected.append((doc_id or -1, len(ids), *digests))
    result = bpe_digests(odd_docs, RANKS, pattern).drop("ids").collect()
    assert sorted((row[0] or -1, *row[1:]) for row in result) == sorted(expected)
    assert bpe_digests(no_docs, RANKS, pattern).count() == 0


@pytest.mark.parametrize("letters", [LETTERS, "ab ", "the re\n"])
def test_counts_are_the_librarys(letters):
    counter = PieceCounter(MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = random_texts(2, letters)
    assert counter.count(texts) == [len(ids) for ids in library.encode(texts)]


def test_counts_table(odd_docs, odd_rows, no_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    expected = []
    for doc_id, text in odd_rows:
        n = len(library.encode(text or ""))
        expected.append((doc_id or -1, len((text or "").encode()), n, n > 4096))
    result = token_counts(odd_docs, MODEL).collect()
    assert sorted((row[0] or -1, *row[1:]) for row in result) == sorted(expected)
    assert token_counts(no_docs, MODEL).count() == 0


@pytest.mark.parametrize("size", [0, 1, 511, 512, 513, 4000])
@pytest.mark.parametrize("most", [200, 60_000, 2**32 - 1])
def test_any_token_of_a_file(size, most):
    rng = np.random.default_rng(size)
    ids = rng.integers(0, most, size, dtype=np.uint32)
    opened = TokenFile(to_bytes([3, None], [size // 3, size - size // 3], ids))
    assert [opened.token(i) for i in range(size)] == ids.tolist()
    for first in range(0, size, 97):
        for end in (first, first + 1, min(size, first + 700)):
            assert opened.ids(first, end).tolist() == ids[first:end].tolist()
    assert [doc[0] for doc in opened.documents()] == [3, None]


def test_chunks_are_the_librarys():
    library = Tokenizer.from_file(WORDS)
    coder = LibraryIds(WORDS)
    texts = random_texts(3) + ["Don't. Stop, HE'LL <|ENDOFTEXT|>", "ΑΣ. Σς,", "क़.", "a_. x,"]
    found = coder.encode([text.encode() for text in texts])
    for text, ids in zip(texts, found, strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text


@pytest.mark.parametrize(
    "change",
    [
        lambda told: told["normalizer"]["normalizers"].pop(),
        lambda told: told["pre_tokenizer"]["pretokenizers"][0]["pattern"].update(Regex="[a-z]+"),
        lambda told: told["pre_tokenizer"]["pretokenizers"][1].update(use_regex=True),
        lambda told: told["added_tokens"][0].update(lstrip=True),
        lambda told: told["model"].update(dropout=0.1),
        lambda told: told.update(pre_tokenizer=None),
    ],
)
def test_tokenizers_with_other_rules_are_refused(tmp_path, change):
    with open(WORDS, encoding="utf-8") as file:
        told = json.load(file)
    change(told)
    path = tmp_path / "other.json"
    path.write_text(json.dumps(told))
    with pytest.raises(ValueError, match="rules"):
        LibraryIds(str(path))


def test_distinct_words():
    texts = [text.encode() for text in random_texts(6)] + [b"x" * 25 + b" " + b"x" * 26, b"\0 \0\0"]
    unique, place, before = distinct_words(texts)
    assert len(set(unique)) == len(unique)
    words = [unique[i] for i in place.tolist()]
    assert words == [word for text in texts for word in text.split()]
    assert np.diff(before).tolist() == [len(text.split()) for text in texts]


@pytest.mark.parametrize("most", [50, 4 << 20])
def test_stored_tokens(odd_docs, odd_rows, no_docs, most):
    library = Tokenizer.from_file(WORDS)
    start, expected = 0, []

    def place(row):
        digest = xxhash.xxh64_intdigest((row[1] or "").encode(), 42)
        return row[0] is not None, row[0] or 0, digest - (digest >> 63 << 64)

    ordered = sorted(odd_rows, key=place)
    for doc_id, text in ordered:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        raw = np.array(ids, "<u4").tobytes()
        expected.append((doc_id or -1, start, len(ids), raw))
        start += len(ids)
    result = stored_tokens(odd_docs, WORDS, most=most).collect()
    assert sorted((row[0] or -1, row[1], row[2], bytes(row[3])) for row in result) == sorted(expected)
    if most > 50:
        digest = stored_token_digest(odd_docs, WORDS).collect()
        assert sorted((row[0] or -1, *row[1:]) for row in digest) == sorted(
            (*row[:3], zlib.crc32(row[3])) for row in expected
        )
        assert stored_tokens(no_docs, WORDS).count() == 0
