"""Encoding by forced boundaries against the library itself."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.test_tokens import LETTERS, random_texts
from tremorlane.llm.forced_boundary import BoundaryBpe, boundary_digests, boundary_round_trip
from tremorlane.llm.queries import BYTE_PAIRS

PATH = public_tokenizers.path(BYTE_PAIRS)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize(
    "letters",
    [LETTERS, "aeinort", "ab '", "s'!  §  　x\n\t\x1c\x85éд日", "'sdltrev  \n", "a1.,' \x00\x7f²"],
)
def test_ids_and_text_are_the_librarys(library, letters):
    coder = BoundaryBpe(PATH)
    texts = random_texts(11, letters)
    texts += [f"{a}<|endoftext|>{b}" for a, b in zip(texts[::9], texts[1::9], strict=False)]
    for text, raw in zip(texts, coder.encode([text.encode() for text in texts]), strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == ids, text
        assert coder.decode(raw).decode() == library.decode(ids, skip_special_tokens=False)


def test_names_of_special_tokens_as_text():
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    coder = BoundaryBpe(PATH, specials=False)
    for text in ("<|endoftext|>", "a <|endoftext|>\n<|endoftext|>b"):
        found = np.frombuffer(coder.encode([text.encode()])[0], "<u4").tolist()
        assert found == library.encode(text, add_special_tokens=False).ids


def test_cuts_are_where_no_token_reaches():
    coder = BoundaryBpe(PATH)
    text = "He said: it's 12pm,  isn't it? Größe и слово".encode()
    codes = np.frombuffer(text, np.uint8)
    starts = coder.starts(codes, np.array([0])).tolist()
    words = [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)], strict=True)]
    assert words[:8] == [b"He", b" said", b":", b" it", b"'s", b" 12", b"pm", b","]
    assert all(not coder.inside[codes[at - 1], codes[at]] for at in starts[1:])
    only = coder.starts(codes, np.array([0]), b" ").tolist()
    assert set(only) < set(starts) and all(text[at : at + 1] == b" " for at in only[1:])


def test_ids_of_half_a_character_decode_as_the_library_does(library):
    coder = BoundaryBpe(PATH)
    ids = np.frombuffer(coder.encode(["😀é日".encode()])[0], "<u4")
    for a in range(len(ids)):
        for b in range(a, len(ids) + 1):
            part = ids[a:b]
            expected = library.decode(part.tolist(), skip_special_tokens=False)
            assert coder.decode(part.tobytes()).decode() == expected


def test_other_rules_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        told = json.load(file)
    told["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(told))
    with pytest.raises(ValueError, match="byte-level"):
        BoundaryBpe(str(path))


def test_table(library, odd_docs, odd_rows, no_docs):
    expected = []
    for doc_id, text in odd_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        parts = (np.array(ids, "<u4").tobytes(), decoded.encode())
        expected.append((doc_id or -1, len(ids), *(hashlib.sha256(part).hexdigest() for part in parts)))
    result = boundary_digests(odd_docs, PATH).collect()
    assert sorted((row[0] or -1, *row[1:]) for row in result) == sorted(expected)
    decoded = boundary_round_trip(odd_docs, PATH).collect()
    assert sorted(bytes(row["decoded"]) for row in decoded) == sorted(
        (text or "").encode() for _, text in odd_rows
    )
    assert boundary_digests(no_docs, PATH).count() == 0


def test_fragments_merged_in_step_are_merged_one_by_one():
    """Many fragments in step, with repeats and equal ranks, against each on its own."""
    coder = BoundaryBpe(PATH)
    rng = np.random.default_rng(11)
    for letters in (b"aan the", bytes(range(256)), "éñ日ation ".encode()):
        texts = [bytes(rng.choice(list(letters), int(size))) for size in rng.integers(1, 60, 800)]
        texts += [b"a" * size for size in range(1, 60)]
        expected = []
        for text in texts:
            symbols = coder._merge_many([coder.of_byte[byte] for byte in text])
            expected.append(np.array(symbols, "<u4").tobytes())
        assert coder._merge_short(texts) == expected
        assert coder._merged(texts) == expected
    assert coder._merged([]) == []
