"""Exact copies against a dictionary of normalised texts."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest

from tremorlane.llm.exact_dedup import drop_exact_copies, exact_copies, normalised


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("text", ["", " ", "\t\n", " a  b\n", "a  b", "\x1c a", "a"])
def test_normalised(text):
    assert normalised(text.encode()) == plain(text).encode()


@pytest.mark.parametrize("block_bytes", [7, 64, 16 << 10])
def test_groups(odd_docs, odd_rows, block_bytes):
    groups = defaultdict(list)
    for doc_id, text in odd_rows:
        groups[plain(text)].append(doc_id)
    rows = exact_copies(odd_docs, block_bytes).collect()
    assert len(rows) == len(odd_rows)
    of_sha = {hashlib.sha256(text.encode()).hexdigest(): ids for text, ids in groups.items()}
    kept = defaultdict(int)
    for row in rows:
        ids = of_sha[row["text_sha256"]]
        named = [doc_id for doc_id in ids if doc_id is not None]
        assert row["keep_id"] == (min(named) if named else None)
        assert row["group_size"] == len(ids)
        if row["kept"]:
            kept[row["text_sha256"]] += 1
            assert row["doc_id"] == row["keep_id"]
    assert kept == {sha: 1 for sha in of_sha}


def test_texts_that_differ_in_one_block(docs_of):
    base = "x" * 100
    rows = [(i, base[:i] + "y" + base[i + 1 :]) for i in range(100)] + [(100, base), (101, base + "x")]
    assert all(row["group_size"] == 1 for row in exact_copies(docs_of(rows), 8).collect())


def test_kept_rows(odd_docs, odd_rows, no_docs):
    kept = drop_exact_copies(odd_docs, 32)
    assert kept.columns == odd_docs.columns
    texts = [plain(row["text"]) for row in kept.collect()]
    assert sorted(texts) == sorted({plain(text) for _, text in odd_rows})
    assert drop_exact_copies(no_docs).count() == 0
    assert exact_copies(no_docs).count() == 0
