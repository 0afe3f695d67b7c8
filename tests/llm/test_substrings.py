"""Suffix arrays against sorting, and repeated substrings against a set of windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import tremorlane.llm.substring_dedup as module
from tremorlane.llm.substring_dedup import contexts, remove_repeats, repeat_digest
from tremorlane.llm.suffix_array import suffix_array


@pytest.mark.parametrize("letters", [1, 2, 3, 20])
def test_suffix_array(letters):
    random.seed(letters)
    for size in [*range(12), *[random.randint(12, 90) for _ in range(300)]]:
        codes = [random.randint(1, letters) for _ in range(size)] + [0]
        expected = sorted(range(len(codes)), key=lambda i: codes[i:])
        assert suffix_array(np.array(codes)) == expected


def test_equal_windows_have_equal_contexts_or_anchors():
    random.seed(1)
    shared = bytes(random.choices(b"abcd ", k=400))
    left, right = b"x" * 130 + shared, shared + bytes(random.choices(b"efgh", k=50))
    piece, first, count, anchor, key, _ = contexts([left, right])
    covered = {0: {}, 1: {}}
    for row in range(len(piece)):
        for i in range(count[row]):
            offset = first[row] + anchor[row] - first[row] - i
            covered[int(piece[row])][int(first[row]) + i] = (int(key[row]), int(offset))
    assert set(covered[0]) == set(range(len(left) - 99))
    assert set(covered[1]) == set(range(len(right) - 99))
    for i in range(301):
        assert covered[0][130 + i] == covered[1][i]


def plain(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            window = data[i : i + 100]
            if window in seen:
                gone[i : i + 100] = True
            seen.add(window)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        runs = int((np.diff(np.r_[0, gone.astype(int), 0]) == 1).sum())
        out[doc_id] = (len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def corpus():
    random.seed(9)
    words = ["".join(random.choices("abcdeé", k=random.randint(1, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(random.choices(words, k=n))

    passages = [prose(n) for n in (12, 25, 60, 300)]
    rows = []
    for i in range(120):
        parts = [prose(random.randint(0, 60)), random.choice(passages), prose(random.randint(0, 30))]
        rows.append((i, " ".join(parts)))
    base = prose(200)
    for i in range(120, 160):  # near copies with an edit each
        at = random.randrange(len(base))
        rows.append((i, base[:at] + random.choice("xyz") + base[at + 1 :]))
    rows += [(200, "a" * 1500), (201, "ab" * 700), (202, "a" * 99), (203, "a" * 100), (204, "")]
    rows += [(205, base), (206, base), (207, f"{base} {base}"), (208, base[:150])]
    return rows


@pytest.mark.parametrize("group", [1_024, 3])
@pytest.mark.parametrize("piece", [1 << 20, 700])
def test_repeats(docs_of, monkeypatch, group, piece):
    monkeypatch.setattr(module, "GROUP", group)
    monkeypatch.setattr(module, "PIECE_BYTES", piece)
    rows = corpus()
    found = {row[0]: tuple(row[1:]) for row in repeat_digest(docs_of(rows)).collect()}
    assert found == plain(rows)


def test_pieces_of_a_long_text(monkeypatch):
    monkeypatch.setattr(module, "PIECE_BYTES", 250)
    text = bytes(range(256)) * 8
    starts = [
        base + i for base, piece in module._cut(text) for i in range(len(piece) - module.LENGTH + 1)
    ]
    assert starts == list(range(len(text) - 99))


def test_large_groups_in_several_blocks(monkeypatch):
    """What a worker does with contexts that are dealt out, block by block."""
    monkeypatch.setattr(module, "BLOCK_BYTES", 3_000)
    random.seed(3)
    common = bytes(random.choices(b"abcdefgh", k=160))
    rows = []
    for i in range(60):
        noise = bytes(random.choices(b"ijklmnop", k=40))
        rows.append((True, 7, i, 10, 40, noise + common[:129]))
    names = ["many", "key", "ord", "at", "anchor", "text"]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names)
    out = pa.Table.from_batches(module._decide(iter([batch]))).to_pylist()
    windows = [row for row in out if row["windows"]]
    gone = {(row["ord"], row["at"] + i) for row in out if not row["windows"] for i in range(row["size"])}
    blocks = -(-60 * 169 // 3_000)
    shared = [row for row in windows if row["at"] >= 50]
    assert 30 <= len(shared) <= 30 * (blocks + 1)
    # Six bytes of noise or more tell a window from all others.
    assert sum(row["at"] <= 44 for row in windows) == 60 * 35
    assert {order for order, _ in gone} < set(range(1, 60))


def test_odd_documents(odd_docs, odd_rows, no_docs):
    rows = remove_repeats(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    by_id = {row["doc_id"]: row for row in rows if row["doc_id"] is not None}
    assert by_id[11]["kept"] == b"" and len(by_id[11]["spans"]) == 1
    assert by_id[6]["n_bytes"] == len(dict(odd_rows)[6])
    assert bytes(by_id[10]["kept"]).decode() == dict(odd_rows)[10]
    assert [by_id[i]["n_bytes"] for i in (3, 4)] == [0, 0]
    assert by_id[12]["spans"][0].asDict() == {"start": 2, "end": 800}
    assert remove_repeats(no_docs).count() == 0


def test_rows_that_share_an_id_are_documents_of_their_own(docs_of):
    """Against windows of all rows in their stated order; no unique byte goes."""
    random.seed(8)

    def letters(n):
        return "".join(random.choices("abcdefghij ", k=n))

    shared, other = letters(200), letters(260)
    rows = [(1, shared), (5, shared + letters(50)), (5, letters(300)), (5, other), (5, other)]
    rows += [(5, letters(150) + other[:120]), (None, shared), (None, letters(300)), (None, other)]
    rows += [(None, letters(30) + shared), (4, letters(130)), (6, other), (6, other), (7, None)]

    def place(row):
        digest = xxhash.xxh64_intdigest((row[1] or "").encode(), 42)
        return row[0] is None, row[0] or 0, digest - (digest >> 63 << 64)

    ordered = sorted(rows, key=place)
    expected = plain([(i, text or "") for i, (_, text) in enumerate(ordered)])
    expected = sorted((doc_id or -1, *expected[i]) for i, (doc_id, _) in enumerate(ordered))
    found = repeat_digest(docs_of(rows)).collect()
    assert sorted((row[0] or -1, *row[1:]) for row in found) == expected
